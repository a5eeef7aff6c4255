"""Small literal inputs."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import functions as F

from cubestar.schema import METADATA, RAW_COLUMNS

D1, D2, D3 = (dt.date(2024, 1, d) for d in (1, 15, 31))
BASE = {
    "tabela_sidra_id": "1", "NC": "6", "NN": "Town", "D1C": "100", "D1N": "A",
    "MC": "10", "MN": "Units", "D2C": "5", "D2N": "Var", "D3C": "202001",
    "D4C": "7", "D4N": "Cat", "V": "1", "modificacao": D1,
}


def observations(spark, *rows, extra=()):
    """Rows given as overrides of ``BASE``."""
    columns = ["tabela_sidra_id", "modificacao", *RAW_COLUMNS, *extra]
    filled = [{**BASE, **r} for r in rows]
    kinds = {"modificacao": "date", "pos": "int"}
    schema = ", ".join(f"{c} {kinds.get(c, 'string')}" for c in columns)
    return spark.createDataFrame([tuple(r.get(c) for c in columns) for r in filled], schema)


def metadata(spark, *cubes):
    """Cube descriptions given as nested dicts; missing fields are NULL."""
    lines = [json.dumps(c, default=str) for c in cubes]
    text = spark.createDataFrame([(line,) for line in lines], "value string")
    return text.select(F.from_json("value", METADATA).alias("m")).select("m.*")


def cube(id="1", frequency="mensal", periods=("202001", "202002"), variables=None, classes=()):
    return {
        "id": id,
        "nome": f"Cube {id}",
        "periodicidade": {"frequencia": frequency},
        "periodos": [
            {"id": p, "literals": [p], "frequencia": frequency, "ano": int(p[:4]),
             "mes": int(p[4:6]) if frequency == "mensal" else None,
             "modificacao": "2024-01-01"}
            for p in periods
        ],
        "localidades": [],
        "variaveis": variables or [{"id": "5", "nome": "Var", "unidade": "BRL"}],
        "classificacoes": [
            {"id": str(i), "categorias": [
                k if isinstance(k, dict) else {"id": str(k), "nome": f"cat {k}"} for k in cats
            ]}
            for i, cats in classes
        ],
    }


def values(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]
