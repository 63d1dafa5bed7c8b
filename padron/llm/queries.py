"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from padron.llm import hilbert_packing, langid, lexical_search, license_index, merkle_manifest, nn_descent, oph_minhash, ordinal_toxicity, pattern_packing, phrase_index, secret_automata, sentence_spans, suffix_dedup
from padron.llm.common import table


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predict_languages(spark, table(spark, sf_dir, "documents"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(spark, table(spark, sf_dir, "documents"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return secret_automata.scan(documents, secret_automata.train(documents))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert_packing.pack(spark, table(spark, sf_dir, "documents"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_index.match(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return oph_minhash.near_duplicates(spark, table(spark, sf_dir, "documents"))


def op7_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nn_descent.near_duplicates(spark, table(spark, sf_dir, "embeddings"))


def op8_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_spans.remove_repeats(spark, table(spark, sf_dir, "documents"), sentence_spans.PRODUCTION_WORDS)


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_index.scan_licenses(spark, table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordinal_toxicity.toxicity(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_manifest.verify(spark, table(spark, sf_dir, "documents"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.rank_documents(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pattern_packing.pack(spark, table(spark, sf_dir, "documents"))


def queries():
    own = op1_language_id, op2_suffix_dedup, op3_secret_scan, op4_packing, op5_decontamination, op6_minhash, op7_nn_descent, op8_sentence_spans, op9_license_scan, op10_toxicity
    return {f.__name__: f for f in (*own, op11_merkle_manifest, op12_lexical_search, op13_pattern_packing)}


# DuckDB's lower() folds more than A-Z
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = f"regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

_OP5 = f"""with d as (select doc_id, coalesce({_WORDS}, []) as ws from documents),
i as (select item_id, {_WORDS} as ws from benchmark where text is not null),
w as (select distinct item_id, least(len(ws), 10) as n, array_to_string(ws[p : p + least(len(ws), 10) - 1], ' ') as gram
    from (select item_id, ws, unnest(range(1, len(ws) - least(len(ws), 10) + 2)) as p from i where len(ws) > 0)),
g as (select doc_id, p, n, array_to_string(ws[p : p + n - 1], ' ') as gram
    from (select doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) as p from d cross join (select distinct n from w) where len(ws) >= n)),
h as (select doc_id, p, g.n, item_id from g join w on g.gram = w.gram and g.n = w.n),
c as (select doc_id, count(distinct q) as n_hit from (select doc_id, unnest(range(p, p + n)) as q from h) group by doc_id),
k as (select doc_id, count(*) as n_items, string_agg(id, ',' order by id) as ids from (select distinct doc_id, cast(item_id as string) as id from h) group by doc_id)
select d.doc_id, len(ws) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items, sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join c on d.doc_id = c.doc_id left join k on d.doc_id = k.doc_id"""

_OP6 = f"""with recursive w as (select doc_id, coalesce(regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+'), []) as ws from documents),
s as (select distinct doc_id, sh from (select doc_id, unnest(case when len(ws) = 0 then [] when len(ws) < 5 then [array_to_string(ws, ' ')]
    else list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i : i + 4], ' ')) end) as sh from w)),
n as (select doc_id, count(*) as n from s group by doc_id),
l as (select x.doc_id as a, y.doc_id as b from s x join s y on x.sh = y.sh and x.doc_id <> y.doc_id join n p on p.doc_id = x.doc_id join n q on q.doc_id = y.doc_id
    group by x.doc_id, y.doc_id, p.n, q.n having 100 * count(*) >= 85 * (p.n + q.n - count(*))),
r(doc_id, node) as (select doc_id, doc_id from documents union select r.doc_id, l.b from r join l on l.a = r.node),
c as (select doc_id, min(node) as component_id from r group by doc_id)
select c.doc_id, coalesce(n, 0) as n_shingles, component_id, component_id = c.doc_id as kept from c left join n on c.doc_id = n.doc_id"""

_OP7 = """with recursive e as (select vec_id, cast(embedding as double[]) as v from embeddings where embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0),
l as (select x.vec_id as a, y.vec_id as b from e x join e y on x.vec_id <> y.vec_id and len(x.v) = len(y.v) where list_cosine_similarity(x.v, y.v) >= 0.95),
r(vec_id, node) as (select vec_id, vec_id from embeddings union select r.vec_id, l.b from r join l on l.a = r.node),
c as (select vec_id, min(node) as component_id from r group by vec_id)
select c.vec_id, (select count(*) from l where l.a = c.vec_id) as n_links, component_id, component_id = c.vec_id as kept from c"""

_FIELD = "coalesce(strlen({0}) || ':' || {0}, '-')"
_CRC = """list_reduce(list_prepend(4294967295::ubigint, list_transform(string_split(cast(doc_id as varchar), ''), lambda c: ascii(c)::ubigint)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), [0::ubigint, 0, 0, 0, 0, 0, 0, 0]), lambda x, y: case when x & 1 = 1 then xor(x >> 1, 3988292384::ubigint) else x >> 1 end))"""


def _leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(_FIELD.format(f"cast({c} as varchar)") for c in ("doc_id", "source", "lang", n_chars, "text")) + ")"


_OP11 = f"""with recursive d as (select doc_id, coalesce('=' || lang, '') as grp, {_leaf("n_chars")} as leaf, {_leaf("n_chars + 1")} as raised, n_chars is not null and xor({_CRC}, 4294967295::ubigint) % 7 = 0 as tampered from documents),
n as (select *, row_number() over (partition by grp order by doc_id nulls first, leaf) - 1 as i from d),
t(grp, lvl, i, h) as (select grp, 0, i, leaf from n
    union all select grp, lvl + 1, i // 2, sha256(string_agg(h, '' order by i)) from (select *, count(*) over (partition by grp) as c from t) where c > 1 group by grp, lvl, i // 2),
s as (select grp, max(lvl) as top, arg_max(h, lvl) as subroot from t group by grp),
g as (select *, row_number() over (order by grp) - 1 as i from s),
u(lvl, i, h) as (select 0, i, subroot from g union all select lvl + 1, i // 2, sha256(string_agg(h, '' order by i)) from (select *, count(*) over () as c from u) where c > 1 group by lvl, i // 2),
r as (select max(lvl) as top, arg_max(h, lvl) as root from u),
steps as (select n.grp, n.i as leaf_i, l as step, (n.i >> l) & 1 as is_right, t.h as sibling from n join s on s.grp = n.grp, lateral (select unnest(range(0, s.top)) as l) x left join t on t.grp = n.grp and t.lvl = l and t.i = xor(n.i >> l, 1)
    union all select n.grp, n.i, g.top + l, (g.i >> l) & 1, u.h from n join g on g.grp = n.grp, r, lateral (select unnest(range(0, r.top)) as l) x left join u on u.lvl = l and u.i = xor(g.i >> l, 1)),
w as (select grp, leaf_i, sha256(coalesce(string_agg(sibling, '' order by step), '')) as proof_sha256, list(case when sibling is null then 'N' when is_right = 1 then 'L' || sibling else 'R' || sibling end order by step) as path from steps group by grp, leaf_i),
o as (select n.doc_id, n.leaf, s.subroot, r.root, coalesce(w.proof_sha256, sha256('')) as proof_sha256,
    list_reduce(list_prepend(case when n.tampered then n.raised else n.leaf end, coalesce(w.path, [])), lambda h, p: sha256(case p[1] when 'L' then p[2:] || h when 'R' then h || p[2:] else h end)) as folded_root
    from n join s on s.grp = n.grp cross join r left join w on w.grp = n.grp and w.leaf_i = n.i)
select *, folded_root = root as verified from o"""

_OP12 = f"""with d as (select row_number() over () as r, doc_id, regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') as ws from documents where text is not null),
c as (select cast(count(*) as bigint) as n, cast(sum(len(ws)) as bigint) as total from d where len(ws) > 0),
p as (select r, doc_id, term, count(*) as tf, any_value(size) as size from (select r, doc_id, len(ws) as size, unnest(ws) as term from d) group by r, doc_id, term),
q as (select distinct item_id, unnest(regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) as term from benchmark where item_id is not null and text is not null),
f as (select term, count(*) as df from p where term in (select term from q) group by term),
w as (select term, cast(floor(1000 * ln((2 * n + 2) / (2 * df + 1))) as bigint) as weight from f, c),
s as (select item_id, r, doc_id, cast(sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * size * n) // total)))) as bigint) as score from q join w using (term) join p using (term), c group by item_id, r, doc_id)
select item_id, cast(rank as int) as rank, doc_id, score from (select *, row_number() over (partition by item_id order by score desc, doc_id nulls first) as rank from s where score > 0) where rank <= 50"""


def oracle_sql() -> dict[str, str]:
    """SQL of the operators that SQL can express; the others learn models, tokenize or cut texts and are
    tested against brute force, round trips or held-out accuracy."""
    return {"op5_decontamination": _OP5, "op6_minhash": _OP6, "op7_nn_descent": _OP7, "op11_merkle_manifest": _OP11, "op12_lexical_search": _OP12}
