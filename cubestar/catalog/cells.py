"""Queries on lookups, cell resolution and the fact merge (J, A, D, T10, T11)."""

from __future__ import annotations

from pyspark.sql import functions as F

from cubestar.catalog import inputs
from cubestar.catalog.members import _old, _resolved
from cubestar.catalog.oracle import (
    DIM_ID,
    PERIODS,
    PLACE_ID,
    batch_inputs,
    cells,
    from_inputs,
    level,
    place_rows,
    star_rows,
)
from cubestar.catalog.registry import query
from cubestar.operators.dimensions import (
    distinct_dimensions,
    distinct_period_codes,
    distinct_places,
    places_from_metadata,
)
from cubestar.operators.facts import (
    accepted,
    deactivate_superseded,
    latest_modification,
    with_fact_id,
)
from cubestar.operators.lookups import (
    dimension_lookup,
    period_by_code,
    period_by_group,
    period_lookup,
    period_match_ratio,
    place_lookup,
    resolve_cells,
    table_periodicity,
)
from cubestar.operators.outputs import join_star
from cubestar.operators.surrogates import KEYS, PLACE_KEY, with_content_keys
from cubestar.plans.load import (
    load_batch,
    load_documents,
    load_metadata,
    save_metadata,
)
from cubestar.schema import DIMENSION_KEY, MEMBER_TABLES, empty_star
from cubestar.sources.star_tables import create_star, read_star
from cubestar.sources.workdir import new_path
from cubestar.streaming.ingest import ingest_documents

_CELL = "tabela_sidra_id, localidade_id, dimensao_id, periodo_id"
_KEYS = ", ".join(DIMENSION_KEY)


@query(
    "j1_place_lookup",
    "WITH " + inputs.with_inputs("old_batch", "balance_obs", "meta_places") + ","
    + cells("old_batch") + "," + cells("balance_obs") + "," + place_rows()
    + f"""
SELECT nc, d1c, {PLACE_ID} AS localidade_id FROM places
WHERE (nc, d1c) IN (SELECT nc, d1c FROM balance_obs_cells)""",
)
def j1(spark, sf):
    star = inputs.star(spark, sf)
    keys = distinct_places(inputs.source(spark, sf, "balance_obs"))
    return with_content_keys(star, place_lookup(star.localidade, keys))


@query(
    "j2_dimension_lookup",
    "WITH " + inputs.with_inputs("old_batch") + "," + cells("old_batch")
    + f"""
SELECT DISTINCT {_KEYS}, {DIM_ID} AS dimensao_id FROM old_batch_cells
WHERE d2c IN (SELECT d2c FROM old_batch_cells WHERE tabela_sidra_id = 'T3')""",
)
def j2(spark, sf):
    fine = _old(spark, sf).filter("tabela_sidra_id = 'T3'")
    star = inputs.star(spark, sf)
    return with_content_keys(star, dimension_lookup(star.dimensao, distinct_dimensions(fine)))


@query(
    "j3_period_lookup",
    "WITH " + inputs.with_inputs("meta_periods", "old_batch") + "," + PERIODS
    + """
SELECT codigo, CASE WHEN frequencia = 'semestral' THEN concat(codigo, '|semestre')
                    ELSE codigo END AS literals, id AS periodo_id
FROM periods WHERE codigo IN (SELECT D3C FROM old_batch WHERE V NOT IN ('...', '-'))""",
)
def j3(spark, sf):
    star = inputs.star(spark, sf)
    lookup = period_lookup(star.periodo, distinct_period_codes(_old(spark, sf)))
    return with_content_keys(star, lookup.withColumn("literals", F.array_join("literals", "|")))


@query(
    "j4_period_by_code",
    "WITH " + inputs.with_inputs("meta_periods", "old_batch") + "," + PERIODS
    + """
SELECT codigo, min(id) AS periodo_id, count(*) AS hits FROM periods
WHERE codigo IN (SELECT D3C FROM old_batch WHERE V NOT IN ('...', '-'))
GROUP BY codigo""",
)
def j4(spark, sf):
    codes = distinct_period_codes(_old(spark, sf))
    star = inputs.star(spark, sf)
    return with_content_keys(star, period_by_code(star.periodo, codes=codes))


@query(
    "j4_ambiguous_in_report",
    batch_inputs("old_batch")
    + """,
allowed(grupo, frequencia) AS (VALUES ('mensal', 'mensal'), ('mensal', 'semestral'), ('anual', 'anual')),
hits AS (
  SELECT a.grupo, p.codigo, count(*) AS hits FROM periods p JOIN allowed a ON a.frequencia = p.frequencia
  GROUP BY ALL)
SELECT c.tabela_sidra_id, count(*) FILTER (c.d2c IS NOT NULL AND h.hits IS NOT NULL) AS staged,
       count(*) FILTER (c.d2c IS NOT NULL AND h.hits IS NULL) AS missing_periods,
       count(*) FILTER (c.d2c IS NOT NULL AND h.hits > 1) AS ambiguous_periods
FROM old_batch_cells c JOIN meta_cubes m ON m.id = c.tabela_sidra_id
LEFT JOIN hits h ON h.grupo = m.frequencia AND h.codigo = c.codigo
GROUP BY c.tabela_sidra_id""",
)
def j4_ambiguous(spark, sf):
    """Monthly cubes may use half-years too: some of their codes then have two periods."""
    pairs = spark.createDataFrame(
        [("mensal", "mensal"), ("mensal", "semestral"), ("anual", "anual")],
        "periodicidade string, frequencia string",
    )
    described = load_metadata(empty_star(spark), inputs.metadata(spark, sf))
    report = load_batch(described, inputs.source(spark, sf, "old_batch"), pairs).report
    return report.select("tabela_sidra_id", "staged", "missing_periods", "ambiguous_periods")


@query(
    "j4_period_by_group",
    "WITH " + inputs.with_inputs("meta_periods") + "," + PERIODS
    + """
SELECT grupo, codigo, min(id) AS periodo_id, count(*) AS hits FROM (
  SELECT frequencia AS grupo, codigo, id FROM periods
  UNION ALL SELECT '' AS grupo, codigo, id FROM periods) AS g
GROUP BY grupo, codigo""",
)
def j4_group(spark, sf):
    star = inputs.star(spark, sf)
    return with_content_keys(star, period_by_group(star.periodo))


_RESOLVED_COLUMNS = f"{_CELL}, codigo, CAST(modificacao AS VARCHAR) AS modificacao, v"


@query(
    "j5_resolve_in_load",
    batch_inputs("old_batch")
    + f"\nSELECT {_RESOLVED_COLUMNS}, TRUE AS ativo, reject_reason FROM old_batch_resolved",
)
def j5_load(spark, sf):
    told = {"localidade_key": "localidade_id", "dimensao_key": "dimensao_id"}
    rows = _resolved(spark, sf, "old_batch").drop("file_path", "period_hits")
    periods = inputs.star(spark, sf)._replace(localidade=None, dimensao=None)
    return with_content_keys(periods, rows).withColumnsRenamed(told)


@query(
    "j5_resolve_by_lookup",
    batch_inputs("old_batch").replace("WITH ", "WITH " + inputs.with_inputs("meta_places") + ",", 1)
    + f""",
known AS MATERIALIZED (SELECT DISTINCT {level('nivel')} AS nc, id AS d1c FROM meta_places),
known_ids AS MATERIALIZED (SELECT {PLACE_ID} AS id FROM known)
SELECT r.tabela_sidra_id, k.id AS localidade_id, r.dimensao_id, r.periodo_id, r.codigo,
       CAST(r.modificacao AS VARCHAR) AS modificacao, r.v, TRUE AS ativo,
       CASE WHEN k.id IS NULL THEN 'localidade' ELSE r.reject_reason END AS reject_reason
FROM old_batch_resolved r LEFT JOIN known_ids k ON k.id = r.localidade_id""",
)
def j5(spark, sf):
    star = inputs.star(spark, sf)
    # Only described places are known here, so customers are rejected.
    places = _described_places(spark, sf, star)
    rows = resolve_cells(
        _old(spark, sf), places, star.dimensao, star.periodo, star.tabela_sidra
    ).drop("file_path", "period_hits")
    return with_content_keys(star, rows)


def _described_places(spark, sf, star):
    """Places of the star that the descriptions name."""
    described = places_from_metadata(inputs.metadata(spark, sf)).select("key")
    keyed = star.localidade.selectExpr("*", f"{PLACE_KEY} AS key")
    return keyed.join(described, "key", "left_semi").drop("key")


@query(
    "j7_star_join",
    f"""{star_rows()}
SELECT tabela_sidra_id, codigo, nc, d1c, d2n, d4n, d5n, v FROM flat""",
)
def j7(spark, sf):
    return join_star(inputs.star(spark, sf)).select(
        "d.tabela_sidra_id", "p.codigo", "l.nc", "l.d1c", "dim.d2n", "dim.d4n",
        "dim.d5n", "d.v",
    )


@query(
    "j8_table_periodicity",
    from_inputs(
        ("meta_cubes",),
        "SELECT id AS tabela_sidra_id, frequencia AS periodicidade FROM meta_cubes",
    ),
)
def j8(spark, sf):
    return table_periodicity(inputs.star(spark, sf).tabela_sidra)


# --- aggregates of a load -------------------------------------------------


@query(
    "a1_latest_modification",
    batch_inputs("new_batch")
    + """
SELECT tabela_sidra_id, periodo_id, CAST(max(modificacao) AS VARCHAR) AS max_modificacao
FROM new_batch_resolved WHERE reject_reason IS NULL GROUP BY tabela_sidra_id, periodo_id""",
)
def a1(spark, sf):
    latest = latest_modification(accepted(_resolved(spark, sf, "new_batch")))
    return with_content_keys(inputs.star(spark, sf), latest)


_LATEST = """
latest AS MATERIALIZED (
  SELECT tabela_sidra_id, periodo_id, max(modificacao) AS m FROM new_batch_resolved
  WHERE reject_reason IS NULL GROUP BY tabela_sidra_id, periodo_id)"""


@query(
    "a2_deactivate_superseded",
    batch_inputs("old_batch", "new_batch") + "," + _LATEST
    + """
SELECT f.tabela_sidra_id, f.localidade_id, f.dimensao_id, f.periodo_id,
       CAST(f.modificacao AS VARCHAR) AS modificacao,
       coalesce(f.modificacao >= l.m, TRUE) AS ativo, f.v
FROM facts f LEFT JOIN latest l
  ON l.tabela_sidra_id = f.tabela_sidra_id AND l.periodo_id = f.periodo_id""",
)
def a2(spark, sf):
    latest = latest_modification(accepted(_resolved(spark, sf, "new_batch")))
    star = inputs.star(spark, sf)
    return with_content_keys(star, deactivate_superseded(star.dados, latest))


def after(revisions: str) -> str:
    """Oracle CTE ``after``: facts after both publications, with flags."""
    more = "AND f.modificacao = n.modificacao" if revisions == "latest" else ""
    keys = _CELL + (", modificacao" if revisions == "latest" else "")
    newest = (
        """SELECT tabela_sidra_id, periodo_id, max(modificacao) AS m FROM (
      SELECT tabela_sidra_id, periodo_id, m AS modificacao FROM latest
      UNION ALL
      SELECT f.tabela_sidra_id, f.periodo_id, f.modificacao FROM facts f
      JOIN latest l ON l.tabela_sidra_id = f.tabela_sidra_id
                   AND l.periodo_id = f.periodo_id) AS u
    GROUP BY tabela_sidra_id, periodo_id"""
        if revisions == "latest"
        else "SELECT * FROM latest"
    )
    return f"""{_LATEST},
newest AS MATERIALIZED ({newest}),
added AS MATERIALIZED (
  SELECT n.* FROM (
    SELECT *, row_number() OVER (
      PARTITION BY {keys} ORDER BY modificacao DESC, file_path, v) AS rn
    FROM new_batch_resolved WHERE reject_reason IS NULL) AS n
  LEFT JOIN facts f
    ON f.tabela_sidra_id = n.tabela_sidra_id AND f.localidade_id = n.localidade_id
   AND f.dimensao_id = n.dimensao_id AND f.periodo_id = n.periodo_id {more}
  WHERE n.rn = 1 AND f.v IS NULL),
everything AS MATERIALIZED (
  SELECT {_CELL}, modificacao, v, FALSE AS inserted FROM facts
  UNION ALL SELECT {_CELL}, modificacao, v, TRUE FROM added),
after AS MATERIALIZED (
  SELECT e.*, coalesce(e.modificacao >= l.m, TRUE) AS ativo
  FROM everything e LEFT JOIN newest l
    ON l.tabela_sidra_id = e.tabela_sidra_id AND l.periodo_id = e.periodo_id)"""


_AFTER_ROWS = (
    f"\nSELECT {_CELL}, CAST(modificacao AS VARCHAR) AS modificacao, ativo, v FROM after"
)
_BOTH = batch_inputs("old_batch", "new_batch")


@query("t10_load_latest", _BOTH + "," + after("latest") + _AFTER_ROWS)
def t10_latest(spark, sf):
    load = load_batch(inputs.star(spark, sf), inputs.source(spark, sf, "new_batch"))
    return with_content_keys(load.star, load.star.dados)


@query("t10_load_keep_first", _BOTH + "," + after("keep_first") + _AFTER_ROWS)
def t10_keep_first(spark, sf):
    load = load_batch(
        inputs.star(spark, sf), inputs.source(spark, sf, "new_batch"),
        revisions="keep_first",
    )
    return with_content_keys(load.star, load.star.dados)


@query("t10_same_batch_twice", _BOTH + "," + after("latest") + _AFTER_ROWS)
def t10_twice(spark, sf):
    batch = inputs.source(spark, sf, "new_batch")
    once = load_batch(inputs.star(spark, sf), batch)
    twice = load_batch(once.star, batch).star
    return with_content_keys(twice, twice.dados)


@query(
    "t10_undated_rows",
    batch_inputs("new_batch")
    + """
SELECT tabela_sidra_id,
       count(*) FILTER (reject_reason IS NULL AND v NOT LIKE '%7') AS staged,
       count(*) FILTER (reject_reason IS NULL AND v LIKE '%7') AS missing_modifications,
       count(*) FILTER (reject_reason IS NOT NULL) AS other_rejects,
       count(*) AS valued, 0 AS without_state, 0 AS inserted_again
FROM new_batch_resolved GROUP BY tabela_sidra_id""",
)
def t10_undated(spark, sf):
    """Rows without a modification are counted, the others stored, and a repeat changes nothing."""
    batch = inputs.source(spark, sf, "new_batch").withColumn(
        "modificacao", F.expr("CASE WHEN NOT coalesce(V LIKE '%7', false) THEN modificacao END")
    )
    once = load_batch(inputs.star(spark, sf), batch)
    again = load_batch(once.star, batch).report
    cube = "tabela_sidra_id"
    reason = F.col("reject_reason")
    other = once.rejects.groupBy(cube).agg(F.count_if(reason != "modificacao").alias("other_rejects"))
    state = once.merged.groupBy(cube).agg(
        F.count_if(F.col("ativo").isNull() | F.col("modificacao").isNull()).alias("without_state")
    )
    joined = once.report.join(other, cube, "left").join(state, cube, "left")
    other = F.coalesce("other_rejects", F.lit(0)).alias("other_rejects")
    return joined.join(
        again.select(cube, F.col("inserted").alias("inserted_again")), cube
    ).select(
        cube, "staged", "missing_modifications", other,
        (F.col("staged") + F.col("missing_modifications") + F.coalesce("other_rejects", F.lit(0))).alias("valued"),
        F.coalesce("without_state", F.lit(0)).alias("without_state"), "inserted_again",
    )


@query("t10_published", _BOTH + "," + after("latest") + _AFTER_ROWS)
def t10_published(spark, sf):
    star = read_star(spark, inputs.published_path(spark, sf))
    return with_content_keys(star, star.dados)


@query(
    "t1_refreshed_output",
    _BOTH + "," + after("latest")
    + """
SELECT a.tabela_sidra_id AS cube, p.codigo AS periodo, count(*) AS n,
       count(*) FILTER (a.v = '999') AS n_revised, count(DISTINCT a.localidade_id) AS n_places
FROM after a JOIN periods p ON p.id = a.periodo_id WHERE a.ativo GROUP BY ALL""",
)
def t1_refreshed(spark, sf):
    """An output of the first publication whose touched parts were built again."""
    _, schema = inputs.published_names(inputs.published_path(spark, sf))
    place = F.struct("nivel", "localidade_id")
    return spark.table(f"{schema}.cells").groupBy("cube", "periodo").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("v") == "999").alias("n_revised"),
        F.count_distinct(place).alias("n_places"),
    )


_DOCUMENT_ROWS = """
published AS MATERIALIZED (
  SELECT *, TRUE AS first FROM old_batch_resolved
  UNION ALL SELECT *, FALSE FROM new_batch_resolved),
kept AS MATERIALIZED (
  SELECT * FROM (
    SELECT *, row_number() OVER (
      PARTITION BY tabela_sidra_id, localidade_id, dimensao_id, periodo_id, modificacao
      ORDER BY v) AS rn
    FROM published WHERE reject_reason IS NULL) AS x WHERE rn = 1),
newest AS (
  SELECT tabela_sidra_id, periodo_id, max(modificacao) AS m FROM kept
  GROUP BY tabela_sidra_id, periodo_id)"""


@query(
    "t10_load_documents",
    _BOTH + "," + _DOCUMENT_ROWS
    + """
SELECT k.tabela_sidra_id, k.localidade_id, k.dimensao_id, k.periodo_id,
       CAST(k.modificacao AS VARCHAR) AS modificacao, k.modificacao = n.m AS ativo, k.v
FROM kept k JOIN newest n
  ON n.tabela_sidra_id = k.tabela_sidra_id AND n.periodo_id = k.periodo_id""",
)
def t10_documents(spark, sf):
    """JSON documents of all modifications, loaded in one batch.

    Rows of a document are in text order, so the smaller value comes first
    where a document has a cell twice.
    """
    path = new_path(spark, "from-documents")
    create_star(spark, path)
    save_metadata(spark, path, inputs.metadata(spark, sf))
    load_documents(spark, path, inputs.documents(spark, sf))
    star = read_star(spark, path)
    return with_content_keys(star, star.dados)


@query(
    "t10_streamed_documents",
    _BOTH + "," + _DOCUMENT_ROWS
    + """
SELECT k.tabela_sidra_id, k.localidade_id, k.dimensao_id, k.periodo_id,
       CAST(k.modificacao AS VARCHAR) AS modificacao, k.modificacao = n.m AS ativo, k.v
FROM kept k JOIN newest n
  ON n.tabela_sidra_id = k.tabela_sidra_id AND n.periodo_id = k.periodo_id""",
)
def t10_streamed(spark, sf):
    """The same documents in two landings, each taken up by a stream that then stops."""
    path, landing = new_path(spark, "streamed"), new_path(spark, "landings")
    create_star(spark, path)
    save_metadata(spark, path, inputs.metadata(spark, sf))
    documents = inputs.documents(spark, sf)
    first = F.col("file_path").contains("@2024-01-01")
    for landed in (documents.filter(first), documents.filter(~first)):
        landed.write.mode("append").parquet(landing)
        stream = spark.readStream.schema(documents.schema).parquet(landing)
        ingest_documents(stream, path, f"{path}-checkpoint").awaitTermination()
    star = read_star(spark, path)
    return with_content_keys(star, star.dados)


def _report(revisions: str) -> str:
    return f"""{_BOTH},{after(revisions)}
SELECT r.tabela_sidra_id, r.staged, a.inserted, a.deactivated, 0 AS missing_places,
       r.missing_dimensions, r.missing_periods, 0 AS missing_modifications,
       0 AS ambiguous_periods
FROM (
  SELECT tabela_sidra_id, count(*) FILTER (reject_reason IS NULL) AS staged,
         count(*) FILTER (reject_reason = 'dimensao') AS missing_dimensions,
         count(*) FILTER (reject_reason = 'periodo') AS missing_periods
  FROM new_batch_resolved GROUP BY tabela_sidra_id) r
JOIN (
  SELECT tabela_sidra_id, count(*) FILTER (inserted) AS inserted,
         count(*) FILTER (NOT ativo) AS deactivated
  FROM after GROUP BY tabela_sidra_id) a ON a.tabela_sidra_id = r.tabela_sidra_id"""


@query("a3_load_report", _report("latest"))
def a3(spark, sf):
    return load_batch(
        inputs.star(spark, sf), inputs.source(spark, sf, "new_batch")
    ).report


@query("a3_load_report_keep_first", _report("keep_first"))
def a3_keep_first(spark, sf):
    return load_batch(
        inputs.star(spark, sf), inputs.source(spark, sf, "new_batch"),
        revisions="keep_first",
    ).report


@query(
    "a3_first_load_report",
    batch_inputs("old_batch")
    + """
SELECT tabela_sidra_id, count(*) FILTER (reject_reason IS NULL) AS staged,
       count(*) FILTER (reject_reason IS NULL) AS inserted, 0 AS deactivated,
       0 AS missing_places,
       count(*) FILTER (reject_reason = 'dimensao') AS missing_dimensions,
       count(*) FILTER (reject_reason = 'periodo') AS missing_periods,
       0 AS missing_modifications, 0 AS ambiguous_periods
FROM old_batch_resolved GROUP BY tabela_sidra_id""",
)
def a3_first(spark, sf):
    described = load_metadata(empty_star(spark), inputs.metadata(spark, sf))
    return load_batch(described, inputs.source(spark, sf, "old_batch")).report


@query(
    "a5_period_match_ratio",
    batch_inputs("old_batch")
    + """
SELECT tabela_sidra_id, count(DISTINCT codigo) AS codes,
       count(DISTINCT CASE WHEN periodo_id IS NOT NULL THEN codigo END) AS matched
FROM old_batch_resolved GROUP BY tabela_sidra_id""",
)
def a5(spark, sf):
    star = inputs.star(spark, sf)
    return period_match_ratio(_old(spark, sf), star.periodo, star.tabela_sidra)


@query(
    "j5_agreement",
    batch_inputs("old_batch")
    + """
SELECT tabela_sidra_id, reject_reason, count(*) AS n FROM old_batch_resolved
GROUP BY tabela_sidra_id, reject_reason""",
)
def j5_agreement(spark, sf):
    """The lookup form against the stored star gives what the load form gives."""
    star = inputs.star(spark, sf)
    resolved = resolve_cells(
        _old(spark, sf), star.localidade, star.dimensao, star.periodo, star.tabela_sidra
    )
    return resolved.groupBy("tabela_sidra_id", "reject_reason").agg(
        F.count(F.lit(1)).alias("n")
    )


_MEMBER_COUNTS = f"""
SELECT 'localidade' AS table_name, count(*) AS n FROM places
UNION ALL SELECT 'dimensao', count(DISTINCT {DIM_ID}) FROM old_batch_cells WHERE d2c IS NOT NULL
UNION ALL SELECT 'periodo', count(*) FROM periods"""


@query(
    "d8_dense_ids",
    "WITH " + inputs.with_inputs("old_batch", "meta_periods", "meta_places") + "," + PERIODS + ","
    + cells("old_batch") + "," + place_rows()
    + f"\nSELECT table_name, n, 1::BIGINT AS lowest, n AS highest, n AS n_ids FROM ({_MEMBER_COUNTS}) AS c",
)
def d8_dense(spark, sf):
    """Ids of a stored star: as many as rows, from 1 without a gap."""
    star = inputs.star(spark, sf)
    parts = [
        getattr(star, name).agg(
            F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n"), F.min("id").alias("lowest"),
            F.max("id").alias("highest"), F.count_distinct("id").alias("n_ids"),
        )
        for name in MEMBER_TABLES
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "d8_ids_kept",
    "WITH " + inputs.with_inputs("old_batch", "meta_periods", "meta_places") + "," + PERIODS + ","
    + cells("old_batch") + "," + place_rows()
    + f""",
before AS (
  SELECT 'localidade' AS table_name, count(*) AS n_kept FROM (
    SELECT nc, d1c FROM old_batch_cells WHERE tabela_sidra_id = 'T1'
    UNION SELECT nc, d1c FROM meta_place_rows) AS p
  UNION ALL SELECT 'dimensao', count(DISTINCT {DIM_ID}) FROM old_batch_cells
  WHERE d2c IS NOT NULL AND tabela_sidra_id = 'T1')
SELECT c.table_name, n_kept, c.n - n_kept AS n_new, n_kept + 1 AS lowest_new, c.n AS highest_new
FROM ({_MEMBER_COUNTS}) AS c JOIN before b ON b.table_name = c.table_name""",
)
def d8_kept(spark, sf):
    """One cube, then all of them: members keep their ids, new ones follow without a gap."""
    batch = inputs.source(spark, sf, "old_batch")
    described = load_metadata(empty_star(spark), inputs.metadata(spark, sf))
    star = load_batch(described, batch.filter("tabela_sidra_id = 'T1'")).star
    grown = load_batch(star, batch).star
    parts = []
    for name in ("localidade", "dimensao"):
        before, after_ = (
            getattr(s, name).selectExpr(f"id AS {i}", f"{KEYS[name]} AS key") for s, i in ((star, "old"), (grown, "new"))
        )
        both = after_.join(before, "key", "full")
        parts.append(
            both.agg(
                F.lit(name).alias("table_name"), F.count_if(F.col("old") == F.col("new")).alias("n_kept"),
                F.count_if(F.col("old").isNull()).alias("n_new"),
                F.min(F.when(F.col("old").isNull(), F.col("new"))).alias("lowest_new"),
                F.max(F.when(F.col("old").isNull(), F.col("new"))).alias("highest_new"),
            )
        )
    return parts[0].unionByName(parts[1])


@query(
    "d8_fact_ids",
    batch_inputs("old_batch")
    + """
SELECT md5(concat('v', length(tabela_sidra_id), ':', tabela_sidra_id,
                  'v32:', localidade_id, 'v32:', dimensao_id, 'v32:', periodo_id,
                  'v10:', CAST(modificacao AS VARCHAR))) AS id, v
FROM facts""",
)
def d8_facts(spark, sf):
    star = inputs.star(spark, sf)
    return with_fact_id(with_content_keys(star, star.dados)).select("id", "v")


@query(
    "t11_load_metadata",
    "WITH " + inputs.with_inputs("meta_cubes", "meta_periods", "meta_places") + ","
    + PERIODS
    + f"""
SELECT 'tabela_sidra' AS kind, id, nome AS name FROM meta_cubes
UNION ALL SELECT 'periodo', id, codigo FROM periods
UNION ALL SELECT 'localidade', {PLACE_ID} AS id, name FROM (
  SELECT {level('nivel')} AS nc, id AS d1c, min(nome) AS name
  FROM meta_places GROUP BY ALL) AS p""",
)
def t11(spark, sf):
    star = load_metadata(empty_star(spark), inputs.metadata(spark, sf))

    def rows(kind, df, name):
        key = F.expr(KEYS.get(kind, "id")).alias("id")
        return df.select(F.lit(kind).alias("kind"), key, F.col(name).alias("name"))

    return (
        rows("tabela_sidra", star.tabela_sidra, "nome")
        .union(rows("periodo", star.periodo, "codigo"))
        .union(rows("localidade", star.localidade, "d1n"))
    )


@query(
    "t11_reload_metadata",
    "WITH " + inputs.with_inputs("meta_cubes", "meta_periods", "meta_places") + ","
    + PERIODS
    + f"""
SELECT 'tabela_sidra' AS kind, count(*) AS n FROM meta_cubes
UNION ALL SELECT 'periodo', count(*) FROM periods
UNION ALL SELECT 'localidade', count(*) FROM (
  SELECT DISTINCT {level('nivel')} AS nc, id FROM meta_places) AS p""",
)
def t11_twice(spark, sf):
    described = inputs.metadata(spark, sf)
    star = load_metadata(load_metadata(empty_star(spark), described), described)
    parts = [
        getattr(star, name).agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(name).alias("kind"), "n"
        )
        for name in ("tabela_sidra", "periodo", "localidade")
    ]
    return parts[0].union(parts[1]).union(parts[2])
