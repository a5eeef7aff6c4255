"""Names and types of the data model: raw rows, cube metadata, star tables."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Column names, sentinels and ranges of the data model.
SLOTS = ("4", "5", "6", "7", "8", "9")
SLOT_CODES = tuple(f"D{s}C" for s in SLOTS)
RAW_COLUMNS = (
    "NC", "NN", "D1C", "D1N", "MC", "MN", "D2C", "D2N", "D3C",
    *(f"D{s}{kind}" for s in SLOTS for kind in "CN"),
    "V",
)
DIMENSION_KEY = ("mc", "d2c", "d4c", "d5c", "d6c", "d7c", "d8c", "d9c")
DIMENSION_COLUMNS = (
    "mc", "mn", "d2c", "d2n", *(f"d{s}{kind}" for s in SLOTS for kind in "cn")
)
PERIOD_ATTRIBUTES = (
    "frequencia", "data_inicio", "data_fim", "ano", "ano_fim",
    "semestre", "trimestre", "mes",
)
NULL_SENTINELS = ("...", "-")
NUMBER_PREFIX = "^-?[0-9]"
MAX_SLOTS = 6
PERIOD_RANGES = {"semestre": (1, 2), "trimestre": (1, 4), "mes": (1, 12)}


_TYPES = {
    "text": T.StringType(),
    "date": T.DateType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "short": T.ShortType(),
    "flag": T.BooleanType(),
    "texts": T.ArrayType(T.StringType()),
}


def _struct(**fields: str | T.DataType) -> T.StructType:
    return T.StructType(
        [
            T.StructField(name, _TYPES[kind] if isinstance(kind, str) else kind)
            for name, kind in fields.items()
        ]
    )


_PERIOD = {
    "frequencia": "text", "data_inicio": "date", "data_fim": "date",
    "ano": "int", "ano_fim": "int", "semestre": "short", "trimestre": "short",
    "mes": "short",
}
_CATEGORY = _struct(id="text", nome="text", unidade="text")
METADATA = _struct(
    id="text",
    nome="text",
    periodicidade=_struct(frequencia="text"),
    periodos=T.ArrayType(
        _struct(id="text", literals="texts", **_PERIOD, modificacao="date")
    ),
    localidades=T.ArrayType(
        _struct(id="text", nome="text", nivel=_struct(id="text", nome="text"))
    ),
    variaveis=T.ArrayType(_struct(id="text", nome="text", unidade="text")),
    classificacoes=T.ArrayType(
        _struct(id="text", categorias=T.ArrayType(_CATEGORY))
    ),
    nivel_territorial=_struct(
        administrativo="texts", ibge="texts", especial="texts"
    ),
)

STAR_SCHEMAS = {
    "tabela_sidra": _struct(
        id="text", nome="text", periodicidade="text",
        ultima_atualizacao="date", metadados="text",
    ),
    "localidade": _struct(id="long", nc="text", nn="text", d1c="text", d1n="text"),
    "periodo": _struct(id="long", codigo="text", literals="texts", **_PERIOD),
    "dimensao": _struct(id="long", **{c: "text" for c in DIMENSION_COLUMNS}),
    "dados": _struct(
        localidade_id="long", dimensao_id="long", modificacao="date",
        ativo="flag", v="text", tabela_sidra_id="text", periodo_id="long",
    ),
}
# Tables whose rows have dense ids that facts refer to.
MEMBER_TABLES = ("localidade", "dimensao", "periodo")
FACT_COLUMNS = tuple(STAR_SCHEMAS["dados"].fieldNames())
FACT_PARTITIONS = ("tabela_sidra_id", "periodo_id")
CELL_KEY = ("tabela_sidra_id", "localidade_id", "dimensao_id", "periodo_id")

# NOT NULL columns and unique keys, checked by operators.quality.
REQUIRED = {
    "tabela_sidra": ("id", "nome", "periodicidade", "ultima_atualizacao"),
    "localidade": ("id", "nc", "nn", "d1c", "d1n"),
    "periodo": ("id", "codigo"),
    "dimensao": ("id", "mn", "d2c", "d2n"),
    "dados": (*CELL_KEY, "modificacao", "ativo", "v"),
}
UNIQUE = {
    "tabela_sidra": ("id",),
    "localidade": ("nc", "d1c"),
    "periodo": ("codigo", "literals"),
    "dimensao": DIMENSION_KEY,
    "dados": CELL_KEY,
}
FOREIGN_KEYS = {
    "tabela_sidra_id": "tabela_sidra",
    "localidade_id": "localidade",
    "dimensao_id": "dimensao",
    "periodo_id": "periodo",
}


class Star(NamedTuple):
    """The five tables; a load turns one Star into the next."""

    tabela_sidra: DataFrame
    localidade: DataFrame
    periodo: DataFrame
    dimensao: DataFrame
    dados: DataFrame


def empty_star(spark: SparkSession) -> Star:
    return Star(
        *(spark.createDataFrame([], STAR_SCHEMAS[name]) for name in Star._fields)
    )
