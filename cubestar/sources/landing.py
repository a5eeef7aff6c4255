"""Which planned requests are already landed.

A request for a whole level is landed if a document of that name is. A request for
places names them as codes and ranges, ``1,5,100:199`` (both ends included): it is
landed if the union of the ranges of landed documents, which are otherwise the same
request, covers it, and partly landed if it covers some of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cubestar.functions.requests import request_folder, request_key
from cubestar.sources.documents import file_name, list_documents

#: Codes and ranges of one level in a request name.
_PLACES = r"_n([^-_]+)-([0-9]+(?::[0-9]+)?(?:,[0-9]+(?::[0-9]+)?)*)(?=[_@])"


def landed_names(spark: SparkSession, path: str) -> DataFrame:
    """Folder and file name of every landed document; contents are not read."""
    return names_of(list_documents(spark, path))


def names_of(docs: DataFrame) -> DataFrame:
    path = F.col("file_path")
    return docs.select(
        F.element_at(F.split(path, "/"), -2).alias("folder"),
        file_name(path).alias("name"),
    )


def with_request_key(plan: DataFrame) -> DataFrame:
    """Add the landing folder and file name of each planned request."""
    c = F.col
    return plan.withColumns(
        {
            "folder": request_folder(c("tabela_sidra")),
            "name": request_key(
                c("tabela_sidra"), c("territories"), c("periods"),
                c("variables"), c("classifications"), c("format"),
                c("modificacao"),
            ),
        }
    )


def split_plan(plan: DataFrame, landed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(landed, pending) requests of a plan that carries folder and name."""
    names = landed.select("folder", "name")
    return (
        plan.join(names, ["folder", "name"], "left_semi"),
        plan.join(names, ["folder", "name"], "left_anti"),
    )


def _ranges(requests: DataFrame) -> DataFrame:
    """folder, name, request (the name without its places), lo, hi of every range.

    A request without codes or ranges has one row without lo and hi.
    """
    name = F.col("name")
    split = requests.select(
        "folder",
        "name",
        F.regexp_replace(name, _PLACES, "_n$1-?").alias("request"),
        F.explode(F.split(F.regexp_extract(name, _PLACES, 2), ",")).alias("places"),
    )
    ends = F.split("places", ":")
    return split.select(
        "folder",
        "name",
        "request",
        F.get(ends, F.lit(0)).try_cast("bigint").alias("lo"),
        F.element_at(ends, -1).try_cast("bigint").alias("hi"),
    ).where("lo IS NULL OR lo <= hi")


def _united(ranges: DataFrame, keys: list[str]) -> DataFrame:
    """keys, lo, hi: ranges that overlap or touch become one."""
    inside = Window.partitionBy(*keys).orderBy("lo", "hi")
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    opens = F.coalesce((F.col("lo") > F.max("hi").over(before) + 1).cast("int"), F.lit(0))
    numbered = ranges.where("lo IS NOT NULL").withColumn("opens", opens)
    return (
        numbered.withColumn("island", F.sum("opens").over(inside))
        .groupBy(*keys, "island")
        .agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
        .drop("island")
    )


def _met(plan: DataFrame, landed: DataFrame) -> DataFrame:
    """folder, name, lo, hi of a planned range with the landed ranges that meet it."""
    held = _united(_ranges(landed), ["folder", "request"])
    wanted = _united(_ranges(plan), ["folder", "name", "request"])
    held = held.select("folder", "request", F.col("lo").alias("from"), F.col("hi").alias("to"))
    both = wanted.join(held, ["folder", "request"], "left")
    meets = F.expr("from <= hi AND to >= lo")
    return both.select(
        "folder", "name", "lo", "hi",
        F.when(meets, F.greatest("from", "lo")).alias("from"),
        F.when(meets, F.least("to", "hi")).alias("to"),
    ).distinct()


def plan_coverage(plan: DataFrame, landed: DataFrame) -> DataFrame:
    """The plan with state (landed, partial or pending), places and landed_places.

    ``places`` counts the codes that a request names and ``landed_places`` those in
    landed documents; both are NULL for a request that names none.
    """
    parts = _met(plan, landed).groupBy("folder", "name", "lo", "hi").agg(
        F.coalesce(F.sum(F.expr("to - from + 1")), F.lit(0)).alias("held")
    )
    counted = parts.groupBy("folder", "name").agg(
        F.sum(F.expr("hi - lo + 1")).alias("places"), F.sum("held").alias("landed_places")
    )
    named = landed.select("folder", "name", F.lit(True).alias("here")).distinct()
    state = (
        F.when(F.col("here") | (F.col("landed_places") == F.col("places")), F.lit("landed"))
        .when(F.col("landed_places") > 0, F.lit("partial"))
        .otherwise(F.lit("pending"))
    )
    return (
        plan.join(named, ["folder", "name"], "left")
        .join(counted, ["folder", "name"], "left")
        .withColumn("state", state)
        .drop("here")
    )


def missing_places(plan: DataFrame, landed: DataFrame) -> DataFrame:
    """folder, name, lo, hi: the ranges of planned requests that have not landed."""
    of_range = Window.partitionBy("folder", "name", "lo", "hi")
    met = _met(plan, landed).withColumn("met", F.count("to").over(of_range)).where("to IS NOT NULL OR met = 0")
    at = Window.partitionBy("folder", "name", "lo", "hi").orderBy("from")
    gaps = met.select(
        "folder", "name",
        F.coalesce(F.lag("to").over(at) + 1, F.col("lo")).alias("lo"),
        F.coalesce(F.col("from") - 1, F.col("hi")).alias("gap"),
        F.when(F.lead("from").over(at).isNull() & F.col("to").isNotNull(), F.col("to") + 1).alias("last"),
        F.col("hi"),
    )
    ahead = gaps.select("folder", "name", "lo", F.col("gap").alias("hi"))
    behind = gaps.where("last IS NOT NULL").select("folder", "name", F.col("last").alias("lo"), "hi")
    return ahead.unionByName(behind).where("lo <= hi")
