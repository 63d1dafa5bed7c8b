"""K10 to K12: tables reshaped for export."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from padron.functions.clean import stable_id


def graph_nodes_edges(ec: DataFrame, cert: DataFrame, edge: DataFrame) -> tuple[DataFrame, DataFrame]:
    nodes = ec.select(F.concat(F.lit("ec_"), F.col("ec_clave")).alias("id"), F.lit("ec").alias("kind"), F.col("titulo").alias("label")).unionByName(
        cert.select(F.concat(F.lit("cert_"), F.col("cert_id")).alias("id"), F.lit("cert").alias("kind"), F.col("nombre_legal").alias("label")))
    edges = edge.join(ec.select("ec_clave"), "ec_clave", "left_semi").join(cert.select("cert_id"), "cert_id", "left_semi").select(
        F.concat(F.lit("cert_"), F.col("cert_id")).alias("source"), F.concat(F.lit("ec_"), F.col("ec_clave")).alias("target"), F.lit("accredits").alias("type"))
    return nodes, edges


def denormalize_ec(ec: DataFrame, cert: DataFrame, ece_ec: DataFrame, centros: DataFrame, centro_ec: DataFrame) -> DataFrame:
    """Standards with their certifiers and centres nested, sorted; both are gathered before they are joined."""
    def nested(edge, dim, key, name, cols):
        rows = edge.join(dim.select(*cols), key).groupBy("ec_clave").agg(F.sort_array(F.collect_list(F.struct(*cols))).alias(name))
        return rows
    out = ec.join(nested(ece_ec, cert, "cert_id", "certificadores", ["cert_id", "nombre_legal"]), "ec_clave", "left")
    return out.join(nested(centro_ec, centros, "centro_id", "centros", ["centro_id", "nombre"]), "ec_clave", "left")


def denormalize_cert(cert: DataFrame, ec: DataFrame, lists: DataFrame) -> DataFrame:
    """Certifiers with the standards of their own lists nested; unknown codes are dropped. lists(cert_id, codes)."""
    codes = lists.select("cert_id", F.explode(F.array_distinct("codes")).alias("ec_clave")).join(ec.select("ec_clave", "titulo"), "ec_clave")
    return cert.join(codes.groupBy("cert_id").agg(F.sort_array(F.collect_list(F.struct("ec_clave", "titulo"))).alias("estandares")), "cert_id", "left")


def bundle_shapes(ec: DataFrame, cert: DataFrame, ece_ec: DataFrame, centros: DataFrame, centro_ec: DataFrame) -> dict[str, DataFrame]:
    """The graph and the nested documents that go with an export, by folder."""
    nodes, edges = graph_nodes_edges(ec, cert, ece_ec)
    lists = ece_ec.groupBy("cert_id").agg(F.collect_list("ec_clave").alias("codes"))
    return {"graph/nodes": nodes, "graph/edges": edges, "denormalized/ec": denormalize_ec(ec, cert, ece_ec, centros, centro_ec), "denormalized/cert": denormalize_cert(cert, ec, lists)}


def location_dim(cert: DataFrame, centros: DataFrame) -> DataFrame:
    cols = ["estado", "estado_inegi", "municipio", "cp"]
    return cert.select(*cols).unionByName(centros.select(*cols)).distinct().withColumn("location_id", stable_id(F.lit(None).cast("string"), *[F.col(c) for c in cols]))
