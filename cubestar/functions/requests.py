"""The deterministic name of a request."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _joined(c: Column) -> Column:
    return F.array_join(c, ",")


def request_folder(agregado: Column) -> Column:
    return F.concat(F.lit("t-"), agregado)


def request_key(
    agregado: Column,
    territorios: Column,
    periodos: Column,
    variaveis: Column,
    classificacoes: Column,
    formato: Column,
    modificacao: Column,
) -> Column:
    """File name of a request; map entries keep the order they were given in."""

    def level(entry: Column) -> Column:
        codes = _joined(entry["value"])
        return F.concat(
            F.lit("_n"),
            entry["key"],
            F.lit("-"),
            F.when(codes == "", F.lit("all")).otherwise(codes),
        )

    def classification(entry: Column) -> Column:
        return F.concat(F.lit("_c"), entry["key"], F.lit("-"), _joined(entry["value"]))

    return F.concat(
        F.lit("t-"), agregado,
        F.lit("_p-"), _joined(periodos),
        F.lit("_f-"), formato,
        F.array_join(F.transform(F.map_entries(territorios), level), ""),
        F.when(
            F.size(F.coalesce(variaveis, F.array().cast("array<string>"))) > 0,
            F.concat(F.lit("_v-"), _joined(variaveis)),
        ).otherwise(F.lit("")),
        F.array_join(F.transform(F.map_entries(classificacoes), classification), ""),
        F.lit("@"), modificacao.cast("string"),
        F.lit(".json"),
    )
