"""Layouts and constants of the registry data.

Everything here is a fixed value: names, codes, encodings and patterns that the
published files and the silver table are defined by.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import DateType, IntegerType, StringType, StructField, StructType

# The fields of an establishment file, in file order.
ESTABLISHMENT_FIELDS = [
    "cnpj_basico",
    "cnpj_ordem",
    "cnpj_dv",
    "cd_matriz_filial",
    "nome_fantasia",
    "cd_situacao_cadastral",
    "data_situacao_cadastral",
    "cd_motivo_situacao_cadastral",
    "nome_cidade_exterior",
    "pais",
    "data_inicio_atividades",
    "cd_cnae_fiscal",
    "cd_cnae_fiscal_secundario",
    "tipo_logradouro",
    "logradouro",
    "numero",
    "complemento",
    "bairro",
    "cep",
    "uf",
    "municipio",
    "ddd1",
    "telefone1",
    "ddd2",
    "telefone2",
    "ddd_fax",
    "fax",
    "correio_eletronico",
    "cd_situacao_especial",
    "data_situacao_especial",
]

# The columns of the silver table, in order.
SILVER_COLUMNS = [
    "cnpj_basico",
    "cnpj_ordem",
    "cnpj_dv",
    "cnpj",
    "cd_matriz_filial",
    "matriz_filial",
    "nome_fantasia",
    "cd_situacao_cadastral",
    "situacao_cadastral",
    "data_situacao_cadastral",
    "cd_motivo_situacao_cadastral",
    "motivo_situacao_cadastral",
    "nome_cidade_exterior",
    "pais",
    "data_inicio_atividades",
    "cd_cnae_fiscal",
    "cnae_fiscal",
    "cd_cnae_fiscal_secundario",
    "tipo_logradouro",
    "logradouro",
    "numero",
    "complemento",
    "bairro",
    "cep",
    "uf",
    "municipio",
    "ddd1",
    "telefone1",
    "ddd2",
    "telefone2",
    "ddd_fax",
    "fax",
    "correio_eletronico",
    "cd_situacao_especial",
    "data_situacao_especial",
]

# The columns of the silver table in the documented layout, in order.
DOCUMENTED_COLUMNS = [
    "cnpj_basico",
    "cnpj_ordem",
    "cnpj_dv",
    "cnpj",
    "cd_matriz_filial",
    "matriz_filial",
    "nome_fantasia",
    "cd_situacao_cadastral",
    "situacao_cadastral",
    "data_situacao_cadastral",
    "cd_motivo_situacao_cadastral",
    "motivo_situacao_cadastral",
    "nome_cidade_exterior",
    "cd_pais",
    "pais",
    "data_inicio_atividades",
    "cd_cnae_fiscal",
    "cnae_fiscal",
    "cd_cnae_fiscal_secundario",
    "tipo_logradouro",
    "logradouro",
    "numero",
    "complemento",
    "bairro",
    "cep",
    "uf",
    "cd_municipio",
    "municipio",
    "ddd1",
    "telefone1",
    "ddd2",
    "telefone2",
    "ddd_fax",
    "fax",
    "correio_eletronico",
    "cd_situacao_especial",
    "data_situacao_especial",
]

# The only fields that are not text.
INTEGER_FIELDS = {"cd_matriz_filial", "numero"}

# Compact yyyyMMdd text in the file, dates in the silver table.
DATE_FIELDS = ("data_situacao_cadastral", "data_inicio_atividades", "data_situacao_especial")

# The silver columns that are not in the file, by the column they follow.
DERIVED_AFTER = {
    "cnpj_dv": "cnpj",
    "cd_matriz_filial": "matriz_filial",
    "cd_situacao_cadastral": "situacao_cadastral",
    "cd_motivo_situacao_cadastral": "motivo_situacao_cadastral",
    "cd_cnae_fiscal": "cnae_fiscal",
}

# In the documented layout these file columns are codes, and their
# old names become the descriptions that follow them.
DOCUMENTED_CODES = {"pais": "cd_pais", "municipio": "cd_municipio"}

# Registration status labels; any other code, or none, has the default.
STATUS_LABELS = {"01": "Nula", "02": "Ativa", "03": "Suspensa", "04": "Inapta"}
STATUS_DEFAULT = "Baixada"

# Head office and branch.
HEAD_OFFICE_CODE = 1
HEAD_OFFICE, BRANCH = "Matriz", "Filial"

# The main activity of dental clinics.
DENTAL_ACTIVITIES = ("8630504",)

# What is downloaded, matched inside the lower-cased link.
WANTED_ENTITIES = ("cnaes", "motivos", "estabelecimentos")

# Patterns of listings and archive names.
SNAPSHOT_PATTERN = r"(\d{4})-(\d{2})"
ARCHIVE_SUFFIX = ".zip"
ARCHIVE_TAIL_PATTERN = r"\d*\.zip$"
FIELD_SEPARATOR = ";"


def _fields(names: list[str], dates: tuple[str, ...] = ()) -> StructType:
    kinds = dict.fromkeys(INTEGER_FIELDS, IntegerType()) | dict.fromkeys(dates, DateType())
    return StructType([StructField(name, kinds.get(name, StringType())) for name in names])


ESTABLISHMENT = _fields(ESTABLISHMENT_FIELDS)
CODE_TABLE = _fields(["codigo", "descricao"])
SILVER = _fields(SILVER_COLUMNS, DATE_FIELDS)
DOCUMENTED_SILVER = _fields(DOCUMENTED_COLUMNS, DATE_FIELDS)


@dataclass(frozen=True)
class Entity:
    """A folder of same-layout files."""

    folder: str
    schema: StructType
    encoding: str = "UTF-8"


# Folder names and encodings of the published entities.
ESTABLISHMENTS = Entity("Estabelecimentos", ESTABLISHMENT)
REASONS = Entity("Motivos", CODE_TABLE)
ACTIVITIES = Entity("Cnaes", CODE_TABLE, "ISO-8859-1")
COUNTRIES = Entity("Paises", CODE_TABLE, "ISO-8859-1")
MUNICIPALITIES = Entity("Municipios", CODE_TABLE, "ISO-8859-1")
ENTITIES = {e.folder: e for e in (ESTABLISHMENTS, REASONS, ACTIVITIES, COUNTRIES, MUNICIPALITIES)}
