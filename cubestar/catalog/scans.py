"""Queries on sources, codes and sinks (S, P)."""

from __future__ import annotations

from pyspark.sql import functions as F

from cubestar.catalog import inputs
from cubestar.catalog.oracle import (
    RAW,
    cells,
    cleaned,
    from_inputs,
    level,
    nulled,
    star_rows,
)
from cubestar.catalog.registry import query
from cubestar.functions.codes import (
    clean_code,
    coerce,
    dimension_key,
    dimension_names,
    normalize_level,
    null_sentinels,
    numeric_value,
    value_flag,
    with_place_key,
)
from cubestar.operators.dimensions import complete_raw, with_values
from cubestar.operators.expand import dimension_members, plan_periods
from cubestar.operators.outputs import flag_profile
from cubestar.plans.materialize import materialize
from cubestar.schema import DIMENSION_COLUMNS, DIMENSION_KEY, SLOTS
from cubestar.sources.documents import (
    explode_documents,
    files_per_table,
    latest_documents,
    observations_from_documents,
    request_modification,
    request_table,
    with_descriptor,
)
from cubestar.sources.export import export_members
from cubestar.sources.landing import missing_places, names_of, plan_coverage, with_request_key
from cubestar.sources.metadata import (
    catalogue_rows,
    category_rows,
    metadata_json,
    period_rows,
    place_rows,
    variable_rows,
)
from cubestar.sources.split_documents import rows_of_records, split_records
from cubestar.sources.star_tables import register_star
from cubestar.sources.workdir import new_path

_LANDED_ROWS = f"""
both_batches AS (
  SELECT *, {inputs.DOCUMENT_PART} AS part
  FROM (SELECT * FROM old_batch UNION ALL SELECT * FROM new_batch) AS b)"""
_NULLED = ", ".join(f"{nulled(c)} AS {c}" for c in RAW)


@query(
    "s1_observation_scan",
    from_inputs(
        ("old_batch", "new_batch"),
        f"SELECT tabela_sidra_id, CAST(modificacao AS VARCHAR) AS modificacao, {_NULLED}"
        " FROM both_batches",
        _LANDED_ROWS,
    ),
)
def s1(spark, sf):
    docs = inputs.documents(spark, sf)
    return observations_from_documents(docs).select(
        "tabela_sidra_id", "modificacao", *RAW
    )


@query(
    "s1_split_documents",
    from_inputs(
        ("old_batch", "new_batch"),
        f"SELECT tabela_sidra_id, CAST(modificacao AS VARCHAR) AS modificacao, {_NULLED}"
        " FROM both_batches",
        _LANDED_ROWS,
    ),
)
def s1_split(spark, sf):
    """The same rows from documents that are read in parts."""
    records = split_records(inputs.document_pieces(spark, sf))
    return with_descriptor(rows_of_records(records)).select(
        "tabela_sidra_id", "modificacao", *RAW
    )


@query(
    "s2_sentinels_to_null",
    from_inputs(("cells",), f"SELECT tabela_sidra_id, {_NULLED} FROM cells"),
)
def s2(spark, sf):
    return null_sentinels(inputs.source(spark, sf, "cells"))


@query(
    "s3_latest_documents",
    from_inputs(
        ("old_batch", "new_batch"),
        f"""SELECT b.tabela_sidra_id, b.D3C AS period,
       CAST(m.latest AS VARCHAR) AS modification, {_NULLED}
FROM both_batches b
JOIN (SELECT tabela_sidra_id AS cube, D3C AS period, part AS range, max(modificacao) AS latest
      FROM both_batches GROUP BY tabela_sidra_id, D3C, part) m
  ON m.cube = b.tabela_sidra_id AND m.period = b.D3C AND m.range = b.part
     AND m.latest = b.modificacao""",
        _LANDED_ROWS,
    ),
)
def s3(spark, sf):
    docs = latest_documents(inputs.documents(spark, sf))
    return explode_documents(docs).select(
        request_table(F.col("file_path")).alias("tabela_sidra_id"),
        F.regexp_extract("file_path", "_p-([0-9]+)_", 1).alias("period"),
        request_modification(F.col("file_path")).alias("modification"),
        *RAW,
    )


@query(
    "s4_catalogue",
    from_inputs(("meta_cubes",), "SELECT id, nome, frequencia AS periodicidade FROM meta_cubes"),
)
def s4_catalogue(spark, sf):
    return catalogue_rows(inputs.metadata(spark, sf)).drop("metadados")


@query(
    "s4_periods",
    from_inputs(
        ("meta_periods",),
        """SELECT tabela_sidra_id, codigo, frequencia, ano, semestre, mes,
       CASE WHEN frequencia = 'semestral' THEN concat(codigo, '|semestre')
            ELSE codigo END AS literals,
       CAST(modificacao AS VARCHAR) AS modificacao FROM meta_periods""",
    ),
)
def s4_periods(spark, sf):
    return period_rows(inputs.metadata(spark, sf)).select(
        "tabela_sidra_id", "codigo", "frequencia", "ano",
        F.col("semestre").cast("int").alias("semestre"),
        F.col("mes").cast("int").alias("mes"),
        F.array_join("literals", "|").alias("literals"), "modificacao",
    )


@query(
    "s4_places",
    from_inputs(
        ("meta_places",),
        f"""SELECT tabela_sidra_id, {level('nivel')} AS nc, nivel_nome AS nn,
       id AS d1c, nome AS d1n FROM meta_places""",
    ),
)
def s4_places(spark, sf):
    return place_rows(inputs.metadata(spark, sf)).drop("pos")


@query("s4_variables", from_inputs(("meta_variables",), "SELECT * FROM meta_variables"))
def s4_variables(spark, sf):
    return variable_rows(inputs.metadata(spark, sf))


@query(
    "s4_categories",
    from_inputs(
        ("meta_categories",),
        "SELECT tabela_sidra_id, pos, cls_id, cat_id, nome, unidade FROM meta_categories",
    ),
)
def s4_categories(spark, sf):
    return category_rows(inputs.metadata(spark, sf)).drop("cat_pos")


def _requests(spark, sf):
    """One request per described cube: its nation level and one customer level."""
    return inputs.metadata(spark, sf).select(
        F.col("id").alias("tabela_sidra"),
        F.create_map(
            F.lit("3"), F.array().cast("array<string>"),
            F.lit("6"), F.array(F.lit("1"), F.lit("2")),
        ).alias("territories"),
        F.lit(None).cast("array<string>").alias("variables"),
        F.lit(None).cast("map<string,array<string>>").alias("classifications"),
    )


@query(
    "s5_request_key",
    from_inputs(
        ("meta_cubes", "meta_periods", "meta_categories"),
        """SELECT concat('t-', p.tabela_sidra_id) AS folder,
       concat('t-', p.tabela_sidra_id, '_p-', p.codigo, '_f-A_n3-all_n6-1,2_v-all',
              coalesce(c.classes, ''), '@', CAST(p.modificacao AS VARCHAR), '.json') AS name
FROM meta_periods p
LEFT JOIN (
  SELECT tabela_sidra_id, string_agg(concat('_c', cls_id, '-'), '' ORDER BY pos) AS classes
  FROM (SELECT DISTINCT tabela_sidra_id, pos, cls_id FROM meta_categories) AS k
  GROUP BY tabela_sidra_id) c ON c.tabela_sidra_id = p.tabela_sidra_id""",
    ),
)
def s5(spark, sf):
    plan = plan_periods(_requests(spark, sf), inputs.metadata(spark, sf))
    return with_request_key(plan).select("folder", "name")


#: Ranges of places that are asked for of the cubes T2 and T3: across documents, up to
#: a place behind the last of small tables, and far behind them.
_ASKED = ((1, 500), (400, 1199), (0, 40_999), (900_000, 900_999))
_ASKED_SQL = ", ".join(f"({lo}, {hi})" for lo, hi in _ASKED)
_DOCUMENT = inputs.PLACES_PER_DOCUMENT


def _planned(spark, sf):
    """Requests by range for T2 and T3, for whole levels for all other cubes."""
    described = inputs.metadata(spark, sf)
    requests = _requests(spark, sf)
    by_range = F.col("tabela_sidra").isin("T2", "T3")
    whole = requests.filter(~by_range).withColumns(
        {
            "territories": F.create_map(F.lit("3"), F.array().cast("array<string>")),
            "variables": F.array(F.lit("1"), F.lit("2")),
        }
    )
    asked = F.explode(F.array(*(F.lit(f"{lo}:{hi}") for lo, hi in _ASKED)))
    ranged = requests.filter(by_range).withColumn("asked", asked)
    ranged = ranged.withColumn("territories", F.create_map(F.lit("6"), F.array("asked"))).drop("asked")
    return with_request_key(plan_periods(whole.unionByName(ranged), described))


@query(
    "s6_cache_split",
    from_inputs(
        ("old_batch", "new_batch", "meta_periods"),
        f"""SELECT p.tabela_sidra_id AS tabela_sidra, p.codigo AS period, a.lo, a.hi,
       CASE WHEN count(d.part) = 0 THEN 'pending'
            WHEN a.lo IS NULL OR sum(least(a.hi, d.part * {_DOCUMENT} + {_DOCUMENT - 1})
                                     - greatest(a.lo, d.part * {_DOCUMENT}) + 1) = a.hi - a.lo + 1 THEN 'landed'
            ELSE 'partial' END AS state
FROM meta_periods p
LEFT JOIN (VALUES {_ASKED_SQL}) a(lo, hi) ON p.tabela_sidra_id IN ('T2', 'T3')
LEFT JOIN (SELECT DISTINCT tabela_sidra_id, D3C, modificacao, part FROM both_batches) d
  ON d.tabela_sidra_id = p.tabela_sidra_id AND d.D3C = p.codigo AND d.modificacao = p.modificacao
     AND (a.lo IS NULL OR d.part BETWEEN a.lo // {_DOCUMENT} AND a.hi // {_DOCUMENT})
GROUP BY p.tabela_sidra_id, p.codigo, p.modificacao, a.lo, a.hi""",
        _LANDED_ROWS,
    ),
)
def s6(spark, sf):
    covered = plan_coverage(_planned(spark, sf), names_of(inputs.documents(spark, sf)))
    asked = F.split(F.element_at("territories", "6")[0], ":")
    return covered.select(
        "tabela_sidra",
        F.col("periods")[0].alias("period"),
        F.get(asked, F.lit(0)).cast("int").alias("lo"),
        F.get(asked, F.lit(1)).cast("int").alias("hi"),
        "state",
    )


@query(
    "s6_missing_ranges",
    from_inputs(
        ("old_batch", "new_batch", "meta_periods"),
        f"""SELECT p.tabela_sidra_id AS tabela_sidra, p.codigo AS period,
       sum(least(a.hi, x * {_DOCUMENT} + {_DOCUMENT - 1}) - greatest(a.lo, x * {_DOCUMENT}) + 1)::BIGINT AS places
FROM meta_periods p
JOIN (VALUES {_ASKED_SQL}) a(lo, hi) ON p.tabela_sidra_id IN ('T2', 'T3')
JOIN range(0, 1000) r(x) ON x BETWEEN a.lo // {_DOCUMENT} AND a.hi // {_DOCUMENT}
LEFT JOIN (SELECT DISTINCT tabela_sidra_id, D3C, modificacao, part FROM both_batches) d
  ON d.tabela_sidra_id = p.tabela_sidra_id AND d.D3C = p.codigo AND d.modificacao = p.modificacao
     AND d.part = x
WHERE d.part IS NULL GROUP BY ALL""",
        _LANDED_ROWS,
    ),
)
def s6_missing(spark, sf):
    """How many places of the requests by range are still to be asked for."""
    plan = _planned(spark, sf)
    missing = missing_places(plan, names_of(inputs.documents(spark, sf)))
    period = F.regexp_extract("name", "_p-([0-9]+)_", 1)
    return missing.groupBy(
        F.substring_index("folder", "-", -1).alias("tabela_sidra"), period.alias("period")
    ).agg(F.sum(F.expr("hi - lo + 1")).alias("places"))


STAR_JOIN = (
    "FROM dados d JOIN periodo p ON d.periodo_id = p.id"
    " JOIN dimensao dim ON d.dimensao_id = dim.id"
    " JOIN localidade l ON d.localidade_id = l.id"
)
VALUE = "CASE WHEN d.v RLIKE '^-?[0-9]' THEN try_cast(d.v AS DECIMAL(38,10)) END AS valor"
_STANDARD_SQL = f"""
SELECT d.tabela_sidra_id, p.codigo AS periodo, p.ano, p.mes, l.nc AS nivel,
       l.d1c AS localidade_id, dim.d2n AS variavel, dim.d4n AS categoria,
       dim.d5n AS situacao, {VALUE}
{STAR_JOIN} WHERE d.tabela_sidra_id IN ('T1', 'T3') AND d.ativo"""
_STANDARD_ORACLE = """SELECT tabela_sidra_id, codigo AS periodo, ano, mes, nc AS nivel,
       d1c AS localidade_id, d2n AS variavel, d4n AS categoria, d5n AS situacao,
       CAST(num AS VARCHAR) AS valor
FROM flat WHERE tabela_sidra_id IN ('T1', 'T3')"""


def _star_database(spark, sf):
    """The stored star as tables of a database of its own."""
    path = inputs.star_path(spark, sf)
    database = "star_" + path.rsplit("-", 1)[-1]
    if not spark.catalog.databaseExists(database):
        register_star(spark, path, database)
    return database


def _run(spark, sf, *outputs):
    """Materialise outputs in a new schema and give its name."""
    location = new_path(spark, "outputs")
    schema = "analytics_" + location.rsplit("-", 1)[-1]
    materialize(
        spark,
        [{**o, "schema": schema, "sql": o["sql"].replace("{analytics}", schema)} for o in outputs],
        _star_database(spark, sf),
        location,
    )
    return schema


@query("s7_replace_table", f"{star_rows()}\n{_STANDARD_ORACLE}")
def s7(spark, sf):
    schema = _run(
        spark, sf,
        {
            "name": "flat", "strategy": "replace", "sql": _STANDARD_SQL,
            "primary_key": [
                "tabela_sidra_id", "periodo", "nivel", "localidade_id", "variavel",
                "categoria", "situacao",
            ],
            "indexes": [{"name": "ix_place", "columns": ["localidade_id"]}],
        },
    )
    return spark.table(f"{schema}.flat")


@query("s8_view", f"{star_rows()}\n{_STANDARD_ORACLE}")
def s8(spark, sf):
    schema = _run(spark, sf, {"name": "flat", "strategy": "view", "sql": _STANDARD_SQL})
    return spark.table(f"{schema}.flat")


_MEMBERS = """
one AS MATERIALIZED (SELECT * FROM meta_categories WHERE pos = 0),
two AS MATERIALIZED (SELECT * FROM meta_categories WHERE pos = 1),
three AS MATERIALIZED (SELECT * FROM meta_categories WHERE pos = 2),
members AS MATERIALIZED (
  SELECT v.tabela_sidra_id, CAST(NULL AS VARCHAR) AS mc,
         coalesce(one.unidade, two.unidade, three.unidade, v.unidade) AS mn,
         v.id AS d2c, v.nome AS d2n, one.cat_id AS d4c, one.nome AS d4n,
         two.cat_id AS d5c, two.nome AS d5n, three.cat_id AS d6c, three.nome AS d6n,
         CAST(NULL AS VARCHAR) AS d7c, CAST(NULL AS VARCHAR) AS d7n,
         CAST(NULL AS VARCHAR) AS d8c, CAST(NULL AS VARCHAR) AS d8n,
         CAST(NULL AS VARCHAR) AS d9c, CAST(NULL AS VARCHAR) AS d9n
  FROM meta_variables v
  LEFT JOIN one ON one.tabela_sidra_id = v.tabela_sidra_id
  LEFT JOIN two ON two.tabela_sidra_id = v.tabela_sidra_id
  LEFT JOIN three ON three.tabela_sidra_id = v.tabela_sidra_id)"""


@query(
    "s9_csv_export",
    from_inputs(
        ("meta_variables", "meta_categories"),
        f"SELECT {', '.join(DIMENSION_COLUMNS)} FROM members",
        _MEMBERS,
    ),
)
def s9(spark, sf):
    path = new_path(spark, "members-csv")
    export_members(dimension_members(inputs.metadata(spark, sf)), path)
    schema = ", ".join(f"{c} STRING" for c in DIMENSION_COLUMNS)
    return spark.read.schema(schema).csv(path, header=True, escape='"')


# --- codes ----------------------------------------------------------------


@query(
    "p1_coerce",
    """SELECT l_orderkey, l_linenumber, CAST(l_partkey AS VARCHAR) AS code,
       CAST(l_linenumber AS VARCHAR) AS line FROM lineitem""",
)
def p1(spark, sf):
    return inputs.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.expr(coerce("l_partkey")).alias("code"),
        F.expr(coerce("l_linenumber")).alias("line"),
    )


@query(
    "p2_clean_code",
    from_inputs(
        ("cells",),
        f"SELECT D1C AS raw, {cleaned('D1C')} AS code, {cleaned('D5C')} AS slot FROM cells",
    ),
)
def p2(spark, sf):
    return inputs.source(spark, sf, "cells").select(
        F.col("D1C").alias("raw"),
        F.expr(clean_code("D1C")).alias("code"),
        F.expr(clean_code("D5C")).alias("slot"),
    )


@query(
    "p3_normalize_level",
    from_inputs(
        ("cells",),
        f"SELECT NC AS raw, {level('NC')} AS nc, {level('D2C')} AS other FROM cells",
    ),
)
def p3(spark, sf):
    return inputs.source(spark, sf, "cells").select(
        F.col("NC").alias("raw"),
        F.expr(normalize_level("NC")).alias("nc"),
        F.expr(normalize_level("D2C")).alias("other"),
    )


@query(
    "p4_place_key",
    from_inputs(
        ("cells",),
        f"SELECT NC AS raw_level, D1C AS raw_place, {level(cleaned('NC'))} AS nc,"
        f" {cleaned('D1C')} AS d1c FROM cells",
    ),
)
def p4(spark, sf):
    raw = inputs.source(spark, sf, "cells").select(
        F.col("NC").alias("raw_level"), F.col("D1C").alias("raw_place")
    )
    return with_place_key(raw, "raw_level", "raw_place")


@query(
    "p5_dimension_key",
    from_inputs(
        ("cells",),
        f"""SELECT mc, d2c, d4c, d5c, d6c, d7c, d8c, d9c, count(*) AS n
FROM (SELECT MC AS mc, {nulled('D2C')} AS d2c, D4C AS d4c, D5C AS d5c,
             CAST(NULL AS VARCHAR) AS d6c, CAST(NULL AS VARCHAR) AS d7c,
             CAST(NULL AS VARCHAR) AS d8c, CAST(NULL AS VARCHAR) AS d9c
      FROM cells) AS k GROUP BY ALL""",
    ),
)
def p5(spark, sf):
    raw = complete_raw(null_sentinels(inputs.source(spark, sf, "cells")))
    keys = raw.selectExpr(*dimension_key())
    return keys.groupBy(*DIMENSION_KEY).agg(F.count(F.lit(1)).alias("n"))


_NAME_COLUMNS = ("mn", "d2n", *(f"d{s}n" for s in SLOTS))


@query(
    "p6_dimension_defaults",
    from_inputs(
        ("cells",),
        """SELECT coalesce(MN, '') AS mn, coalesce(D2N, '') AS d2n, D4N AS d4n, D5N AS d5n,
       CAST(NULL AS VARCHAR) AS d6n, CAST(NULL AS VARCHAR) AS d7n,
       CAST(NULL AS VARCHAR) AS d8n, CAST(NULL AS VARCHAR) AS d9n FROM cells""",
    ),
)
def p6(spark, sf):
    raw = complete_raw(null_sentinels(inputs.source(spark, sf, "cells")))
    return raw.selectExpr(*dimension_names())


@query(
    "p7_value_filter",
    from_inputs(
        ("cells",),
        """SELECT tabela_sidra_id, count(*) AS n_rows FROM cells
WHERE V NOT IN ('...', '-') GROUP BY tabela_sidra_id""",
    ),
)
def p7(spark, sf):
    valued = with_values(null_sentinels(inputs.source(spark, sf, "cells")))
    return valued.groupBy("tabela_sidra_id").agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "p8_numeric_guard",
    from_inputs(
        ("cells",),
        """SELECT V AS v, CAST(CASE WHEN regexp_matches(V, '^-?[0-9]')
       THEN TRY_CAST(V AS DECIMAL(38,10)) END AS VARCHAR) AS valor FROM cells""",
    ),
)
def p8(spark, sf):
    return inputs.source(spark, sf, "cells").select(
        F.col("V").alias("v"), F.expr(numeric_value("V")).alias("valor")
    )


@query(
    "p9_predicates",
    f"""{star_rows()}
SELECT tabela_sidra_id, codigo AS periodo, d1n AS localidade, v
FROM flat WHERE tabela_sidra_id IN ('T1', 'T2') AND d1c = '1'""",
)
def p9(spark, sf):
    star = inputs.star(spark, sf)
    facts = star.dados.filter(F.col("tabela_sidra_id").isin("T1", "T2") & F.col("ativo"))
    places = star.localidade.filter(F.col("d1c") == "1")
    return (
        facts.join(places.select(F.col("id").alias("localidade_id"), "d1n"), "localidade_id")
        .join(star.periodo.select(F.col("id").alias("periodo_id"), "codigo"), "periodo_id")
        .select(
            "tabela_sidra_id", F.col("codigo").alias("periodo"),
            F.col("d1n").alias("localidade"), "v",
        )
    )


@query(
    "p10_flag_profile",
    from_inputs(
        ("cells",),
        """SELECT tabela_sidra_id, CASE WHEN regexp_matches(V, '^-?[0-9]') THEN 'number'
       WHEN V IN ('X', 'C', '..', '...', '-') THEN V ELSE 'other' END AS flag,
       count(*) AS n
FROM cells GROUP BY ALL""",
    ),
)
def p10(spark, sf):
    return flag_profile(inputs.source(spark, sf, "cells"), "V")


@query(
    "p10_value_flag",
    from_inputs(
        ("cells",),
        """SELECT V AS v, CASE WHEN regexp_matches(V, '^-?[0-9]') THEN 'number'
       WHEN V IN ('X', 'C', '..', '...', '-') THEN V ELSE 'other' END AS flag FROM cells""",
    ),
)
def p10_value(spark, sf):
    return inputs.source(spark, sf, "cells").select(
        F.col("V").alias("v"), F.expr(value_flag("V")).alias("flag")
    )


@query(
    "p11_metadata_json",
    from_inputs(
        ("meta_cubes", "meta_variables", "meta_periods"),
        """SELECT c.id, c.nome, c.frequencia AS periodicidade, v.nome AS first_variable,
       p.codigo AS first_period, CAST(p.modificacao AS VARCHAR) AS modificacao
FROM meta_cubes c
JOIN meta_variables v ON v.tabela_sidra_id = c.id AND v.pos = 0
JOIN (SELECT tabela_sidra_id, min(codigo) AS codigo, min(modificacao) AS modificacao
      FROM meta_periods GROUP BY tabela_sidra_id) p ON p.tabela_sidra_id = c.id""",
    ),
)
def p11(spark, sf):
    text = inputs.metadata(spark, sf).select(metadata_json().alias("j"))

    def at(path, name):
        return F.get_json_object("j", f"$.{path}").alias(name)

    return text.select(
        at("id", "id"), at("nome", "nome"),
        at("periodicidade.frequencia", "periodicidade"),
        at("variaveis[0].nome", "first_variable"),
        at("periodos[0].id", "first_period"),
        at("periodos[0].modificacao", "modificacao"),
    )


@query(
    "a4_files_per_table",
    from_inputs(
        ("old_batch", "new_batch"),
        """SELECT tabela_sidra_id,
       count(*) + CASE WHEN tabela_sidra_id = 'T1' THEN 2 ELSE 0 END AS n_files
FROM (SELECT DISTINCT tabela_sidra_id, D3C, part, modificacao FROM both_batches) AS d
GROUP BY tabela_sidra_id""",
        _LANDED_ROWS,
    ),
)
def a4(spark, sf):
    return files_per_table(inputs.documents(spark, sf))
