"""Category combinations: dimension members and request plans.

A combination is addressed by its number in the product of all classifications
of a cube (the last classification counts fastest). Numbers are cut into blocks
of bounded size and the blocks are spread over the cluster, so the product of a
single large cube is produced by many tasks and no join builds it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cubestar.schema import MAX_SLOTS, SLOTS

BLOCK_SIZE = 65_536
_TEXT_LISTS = "map<string,array<string>>"


def _text(c: Column) -> Column:
    return c.cast("string")


def _classes(metadata: DataFrame) -> Column:
    """Classifications of a cube; a cube without the field has none."""
    empty = F.array().cast(metadata.schema["classificacoes"].dataType)
    return F.coalesce("classificacoes", empty).alias("classificacoes")


def _whole_quotient(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def _product(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(1).cast("bigint"), lambda acc, n: acc * n)


def _with_sizes(df: DataFrame, classes: str) -> DataFrame:
    sized = df.withColumn(
        "sizes", F.transform(classes, lambda c: F.size(c["categorias"]).cast("bigint"))
    )
    stride = F.transform(
        "sizes",
        lambda _, i: _product(F.slice("sizes", i + 2, F.size("sizes"))),
    )
    return sized.withColumns({"strides": stride, "total": _product(F.col("sizes"))})


def _combinations(
    df: DataFrame, classes: str, spread_by: list[str], block_size: int
) -> DataFrame:
    """Add ``block``, the combination number ``n`` and its categories ``combo``."""
    sized = _with_sizes(df, classes).filter("total > 0")
    last_block = _whole_quotient(F.col("total") - 1, F.lit(block_size))
    blocks = sized.withColumn(
        "block", F.explode(F.sequence(F.lit(0).cast("bigint"), last_block))
    ).repartition(*spread_by, "block")
    first = F.col("block") * block_size
    numbered = blocks.withColumn(
        "n",
        F.explode(
            F.sequence(first, F.least(F.col("total"), first + block_size) - 1)
        ),
    )

    def chosen(c: Column, i: Column) -> Column:
        stride, size = F.get("strides", i), F.get("sizes", i)
        at = (_whole_quotient(F.col("n"), stride) % size).cast("int")
        return F.get(c["categorias"], at)

    return numbered.withColumn("combo", F.transform(classes, chosen)).drop(
        "sizes", "strides", "total"
    )


def member_counts(metadata: DataFrame) -> DataFrame:
    """Predicted number of dimension members per cube."""
    sized = _with_sizes(
        metadata.select("id", "variaveis", _classes(metadata)), "classificacoes"
    )
    return sized.select(
        F.col("id").alias("tabela_sidra_id"),
        (F.size("variaveis") * F.col("total")).alias("n_members"),
    )


def dimension_members(
    metadata: DataFrame,
    carry_units: bool = False,
    max_rows: int | None = None,
    block_size: int = BLOCK_SIZE,
    drop_classifications: bool = False,
) -> DataFrame:
    """Every variable with every combination of categories.

    Classification *i* fills slot ``d(4+i)``. A cube with more classifications
    than slots is refused, as its members could not be told apart; with
    ``drop_classifications`` the further ones multiply the rows without a slot.
    The unit is that of the first category, in slot
    order, that has one, else the variable's. With ``carry_units`` a
    combination without a unit takes the one of the combination before it.
    ``max_rows`` refuses a product larger than that before producing it.
    """
    if max_rows is not None:
        total = member_counts(metadata).agg(F.sum("n_members")).first()[0] or 0
        if total > max_rows:
            raise ValueError(f"{total} members exceed max_rows={max_rows}")
    classes = _classes(metadata)
    if not drop_classifications:
        message = F.concat(
            F.lit("cube "), F.col("id"), F.lit(f" has more than {MAX_SLOTS} classifications")
        )
        classes = F.when(F.size(classes) <= MAX_SLOTS, classes).otherwise(
            F.raise_error(message).cast(metadata.schema["classificacoes"].dataType)
        ).alias("classificacoes")
    variables = metadata.select(
        F.col("id").alias("tabela_sidra_id"),
        classes,
        F.posexplode("variaveis").alias("var_pos", "var"),
    )
    rows = _combinations(
        variables, "classificacoes", ["tabela_sidra_id", "var_pos"], block_size
    ).withColumn(
        "own_unit",
        F.get(F.filter("combo", lambda k: k["unidade"].isNotNull()), F.lit(0))["unidade"],
    )
    if carry_units:
        rows = _carry_units(rows)
    slots = []
    for i, s in enumerate(SLOTS[:MAX_SLOTS]):
        member = F.get("combo", F.lit(i))
        slots += [
            _text(member["id"]).alias(f"d{s}c"),
            member["nome"].alias(f"d{s}n"),
        ]
    return rows.select(
        "tabela_sidra_id",
        F.lit(None).cast("string").alias("mc"),
        F.coalesce("own_unit", F.col("var.unidade")).alias("mn"),
        _text(F.col("var.id")).alias("d2c"),
        F.col("var.nome").alias("d2n"),
        *slots,
    )


def _carry_units(rows: DataFrame) -> DataFrame:
    """Last unit seen so far: within each block, plus what earlier blocks left.

    Only one row per block takes part in the window over a whole variable.
    """
    variable = ["tabela_sidra_id", "var_pos"]
    left_over = (
        rows.filter(F.col("own_unit").isNotNull())
        .groupBy(*variable, "block")
        .agg(F.max_by("own_unit", "n").alias("block_unit"))
    )
    blocks = rows.groupBy(*variable, "block").agg(F.count(F.lit(1)).alias("size"))
    before = (
        Window.partitionBy(*variable)
        .orderBy("block")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    brought = (
        blocks.join(left_over, [*variable, "block"], "left")
        .withColumn("brought", F.last("block_unit", ignorenulls=True).over(before))
        .select(*variable, "block", "brought")
    )
    inside = (
        Window.partitionBy(*variable, "block")
        .orderBy("n")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        rows.withColumn("own_unit", F.last("own_unit", ignorenulls=True).over(inside))
        .join(brought, [*variable, "block"], "left")
        .withColumn("own_unit", F.coalesce("own_unit", "brought"))
    )


def unnest_requests(
    classes: DataFrame,
    keys: list[str],
    column: str = "classificacoes",
    block_size: int = BLOCK_SIZE,
) -> DataFrame:
    """One map ``{classification: [category]}`` per combination.

    Category ``0`` is skipped; without classifications there is no request.
    """
    cleaned = classes.withColumn(
        column,
        F.transform(
            column,
            lambda c: F.struct(
                c["id"].alias("id"),
                F.filter(
                    c["categorias"], lambda k: _text(k["id"]) != "0"
                ).alias("categorias"),
            ),
        ),
    ).filter(F.size(column) > 0)
    rows = _combinations(cleaned, column, keys, block_size)
    return rows.withColumn(
        "combination",
        F.map_from_arrays(
            F.transform(column, lambda c: _text(c["id"])),
            F.transform("combo", lambda k: F.array(_text(k["id"]))),
        ),
    ).drop("block", "n", "combo", column)


def merge_classifications(static: Column, combination: Column) -> Column:
    """X4 merge: static entries first, a combination overrides an equal key."""
    overridden = F.transform_values(
        static, lambda k, v: F.coalesce(combination[k], v)
    )
    added = F.map_filter(combination, lambda k, _: ~F.map_contains_key(static, k))
    return F.map_concat(overridden, added)


def expand_requests(
    requests: DataFrame, metadata: DataFrame, combine: bool = False
) -> DataFrame:
    """One row per request to make.

    ``requests`` has request_id, tabela_sidra, territories, variables,
    classifications, unnest (``all``, ``listed`` or NULL), unnest_ids and
    split_variables. Splitting variables is ignored where something is
    unnested, unless ``combine``.
    """
    empty_map = F.create_map().cast(_TEXT_LISTS)
    columns = ["request_id", "tabela_sidra", "territories", "variables", "classifications"]
    described = requests.filter(F.col("unnest").isNotNull()).join(
        metadata.select(
            F.col("id").alias("tabela_sidra"),
            _classes(metadata),
        ),
        "tabela_sidra",
    )
    listed = F.col("unnest") == "listed"

    def is_listed(c: Column) -> Column:
        return F.array_contains("unnest_ids", _text(c["id"]))

    declared = F.coalesce("classifications", empty_map)
    rest = F.filter(
        "classificacoes",
        lambda c: ~is_listed(c) & ~F.map_contains_key(declared, _text(c["id"])),
    )
    static = F.map_concat(
        declared,
        F.map_from_arrays(
            F.transform(rest, lambda c: _text(c["id"])),
            F.transform(rest, lambda c: F.array(F.lit("all"))),
        ),
    )
    prepared = described.withColumns(
        {
            "static": F.when(listed, static).otherwise(empty_map),
            "classificacoes": F.when(
                listed, F.filter("classificacoes", is_listed)
            ).otherwise(F.col("classificacoes")),
        }
    )
    unnested = unnest_requests(prepared, ["request_id"]).withColumn(
        "classifications",
        merge_classifications(F.col("static"), F.col("combination")),
    )
    plain = requests.filter(F.col("unnest").isNull())
    split = F.col("split_variables")
    if combine:
        unnested = unnested.select(*columns, "split_variables")
        plain = plain.select(*columns, "split_variables").unionByName(unnested)
        unnested = None
    one_each = (
        plain.filter(split)
        .withColumn("variable", F.explode("variables"))
        .withColumn("variables", F.array("variable"))
        .select(*columns)
    )
    kept = plain.filter(~split | split.isNull()).select(*columns)
    result = kept.unionByName(one_each)
    return result if unnested is None else result.unionByName(unnested.select(*columns))


def plan_periods(
    requests: DataFrame, metadata: DataFrame, request_format: str = "A"
) -> DataFrame:
    """Every request for every period of its cube.

    Variables default to ``all``; classifications default to an empty category
    list for each classification of the cube.
    """
    described = metadata.withColumn("classificacoes", _classes(metadata)).select(
        F.col("id").alias("tabela_sidra"),
        F.map_from_arrays(
            F.transform("classificacoes", lambda c: _text(c["id"])),
            F.transform("classificacoes", lambda c: F.array().cast("array<string>")),
        ).alias("declared"),
        "periodos",
    )
    planned = requests.join(described, "tabela_sidra").withColumn(
        "period", F.explode("periodos")
    )
    others = [
        c
        for c in requests.columns
        if c not in ("tabela_sidra", "territories", "variables", "classifications")
    ]
    return planned.select(
        *others,
        "tabela_sidra",
        "territories",
        F.coalesce("variables", F.array(F.lit("all"))).alias("variables"),
        F.array(F.col("period.id")).alias("periods"),
        F.coalesce("classifications", "declared").alias("classifications"),
        F.lit(request_format).alias("format"),
        F.col("period.modificacao").alias("modificacao"),
    )
