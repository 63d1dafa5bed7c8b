"""Declared schemas, keys and field lists of the registry tables."""

from __future__ import annotations

from pyspark.sql import types as T

_EC = """ec_clave string, titulo string, version string, vigente boolean, sector string, sector_id int,
comite string, comite_id int, descripcion string, competencias array<string>, nivel string,
duracion_horas int, tipo_norma string, fecha_publicacion date, fecha_vigencia date,
perfil_evaluador string, criterios_evaluacion array<string>, url string, first_seen timestamp,
last_seen timestamp, content_hash string"""
_CERT = """cert_id string, tipo string, nombre_legal string, siglas string, estatus string,
domicilio_texto string, estado string, estado_inegi string, municipio string, cp string,
telefono string, correo string, sitio_web string, representante_legal string,
fecha_acreditacion date, estandares_acreditados array<string>,
contactos_adicionales array<map<string,string>>, src_url string, first_seen timestamp,
last_seen timestamp, row_hash string"""
_CENTRO = """centro_id string, nombre string, certificador_id string, estado string, estado_inegi string,
municipio string, domicilio string, telefono string, extension string, correo string,
sitio_web string, coordinador string, latitud double, longitud double, src_url string,
first_seen timestamp, last_seen timestamp, content_hash string"""
_SECTOR = "sector_id int, nombre string, descripcion string, num_comites int, num_estandares int, fecha_creacion date, src_url string, first_seen timestamp, last_seen timestamp"
_COMITE = """comite_id int, nombre string, sector_id int, descripcion string, objetivo string,
num_estandares int, contacto struct<email:string,phone:string>, fecha_creacion date,
fecha_actualizacion date, estandares array<string>, src_url string, first_seen timestamp, last_seen timestamp"""
_ITEM = """type string, code string, title string, sector string, name string, rfc string,
contact_email string, contact_phone string, address string, city string, state string,
postal_code string, certificador_code string, ec_code string, duration string, modality string,
provider_name string, url string, level string, publication_date string, start_date string,
end_date string, extracted_at timestamp"""
_RUN = "harvest_id string, start_time timestamp, end_time timestamp, mode string, spider_name string, status string, items_scraped int, pages_crawled int, errors int, metadata map<string,string>"


def _schema(ddl: str) -> T.StructType:
    return T.StructType(T._parse_datatype_string(ddl).fields)


class _Lazy(dict):
    """Schemas by table name; parsed when asked for, as parsing needs a running session."""

    ddl = {
        "ec": _EC, "cert": _CERT, "centros": _CENTRO, "sectores": _SECTOR, "comites": _COMITE,
        "ece_ec": "cert_id string, ec_clave string, acreditado_desde date",
        "centro_ec": "centro_id string, ec_clave string",
        "ec_sector": "ec_clave string, sector_id int, comite_id int",
        "items": _ITEM, "runs": _RUN,
        "crawl_map": "url string, url_hash string, parent_url string, title string, type string, depth int, status_code int, content_hash string, crawled_at timestamp",
        "captures": "session string, page_url string, request_url string, method string, resource_type string, status_code int, response_size long, timestamp timestamp, duration_ms double, response_preview string",
    }

    def __missing__(self, name):
        self[name] = s = _schema(self.ddl[name])
        return s


SCHEMAS = _Lazy()

KEYS = {"ec": ["ec_clave"], "cert": ["cert_id"], "centros": ["centro_id"], "sectores": ["sector_id"], "comites": ["comite_id"], "ece_ec": ["cert_id", "ec_clave"], "centro_ec": ["centro_id", "ec_clave"]}

#: Columns of the reduced snapshots kept as baselines.
BASELINE_COLUMNS = {"ec": ["ec_clave", "titulo", "vigente", "sector_id", "nivel"], "cert": ["cert_id", "tipo", "nombre_legal", "estado_inegi", "estatus"]}

# Column order of the CSV exports.
CSV_COLUMNS = {
    "ec": ["ec_clave", "titulo", "vigente", "sector_id", "comite_id", "nivel", "duracion_horas"],
    "cert": ["cert_id", "tipo", "nombre_legal", "siglas", "estado", "estado_inegi", "estatus"],
    "centros": ["centro_id", "nombre", "municipio", "estado", "estado_inegi", "certificador_id"],
    "sectores": ["sector_id", "nombre"],
    "comites": ["comite_id", "nombre", "sector_id"],
}

# Fields that make a record modified.
DIFF_FIELDS_EC = ["titulo", "version", "vigente", "sector_id", "comite_id", "descripcion", "nivel", "duracion_horas", "tipo_norma", "fecha_publicacion", "fecha_vigencia", "perfil_evaluador"]
DIFF_FIELDS_CERT = ["tipo", "nombre_legal", "siglas", "estatus", "domicilio_texto", "estado", "municipio", "telefono", "correo", "sitio_web", "representante_legal"]

# The 32 states and their codes, in the official order.
STATES = (
    "Aguascalientes", "Baja California", "Baja California Sur", "Campeche", "Coahuila", "Colima", "Chiapas", "Chihuahua",
    "Ciudad de México", "Durango", "Guanajuato", "Guerrero", "Hidalgo", "Jalisco", "Estado de México", "Michoacán",
    "Morelos", "Nayarit", "Nuevo León", "Oaxaca", "Puebla", "Querétaro", "Quintana Roo", "San Luis Potosí",
    "Sinaloa", "Sonora", "Tabasco", "Tamaulipas", "Tlaxcala", "Veracruz", "Yucatán", "Zacatecas",
)
STATE_CODES = tuple((name, f"{i:02d}") for i, name in enumerate(STATES, 1))
# Short forms of state names.
STATE_ALIASES = {"cdmx": "Ciudad de México", "mexico": "Estado de México", "edomex": "Estado de México", "nl": "Nuevo León", "bc": "Baja California", "bcs": "Baja California Sur", "qroo": "Quintana Roo", "qro": "Querétaro"}

# Columns of the tables of the older shape, in the order of its exports.
V1_COLUMNS = {
    "ec_standards": ["code", "title", "sector", "level", "publication_date", "status", "url", "first_seen", "last_seen"],
    "certificadores": ["code", "name", "rfc", "contact_email", "contact_phone", "address", "city", "state", "status", "url", "first_seen", "last_seen"],
    "evaluation_centers": ["code", "name", "certificador_code", "contact_email", "contact_phone", "address", "city", "state", "status", "url", "first_seen", "last_seen"],
    "courses": ["name", "ec_code", "duration_hours", "modality", "start_date", "end_date", "provider_name", "city", "state", "url", "first_seen", "last_seen"],
}
