"""Load metadata and batches of observations into a star."""

from __future__ import annotations

import hashlib
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession

from cubestar.functions.codes import null_sentinels
from cubestar.operators.dimensions import (
    complete_raw,
    dimensions_of,
    insert_absent,
    periods_from_metadata,
    places_from_metadata,
    places_of,
    upsert_catalogue,
    upsert_periods,
)
from cubestar.operators.facts import (
    accepted,
    load_report,
    merge_touched,
    rejected,
    touched_partitions,
    untouched,
)
from cubestar.operators.lookups import resolve_by_content
from cubestar.operators.surrogates import MEMBER_KEY, PLACE_KEY, give_ids, with_member_ids
from cubestar.schema import DIMENSION_COLUMNS, FACT_COLUMNS, RAW_COLUMNS, STAR_SCHEMAS, Star
from cubestar.sources.documents import (
    observations_by_descriptor,
    observations_from_documents,
)
from cubestar.sources.star_tables import read_star, replace_described, write_facts
from cubestar.sources.versions import commit, is_committed
from cubestar.sources.workdir import PACKED, freed_shuffles, scratch, stage, staged


class Load(NamedTuple):
    """Outcome of one batch; the frames read staged tables."""

    new_places: DataFrame
    new_dimensions: DataFrame
    merged: DataFrame
    rejects: DataFrame
    report: DataFrame
    star: Star


def load_metadata(
    star: Star, metadata: DataFrame, load_date: Column | None = None
) -> Star:
    """Catalogue, periods and places of all cubes in one job."""
    return star._replace(
        tabela_sidra=upsert_catalogue(star.tabela_sidra, metadata, load_date),
        periodo=upsert_periods(star.periodo, periods_from_metadata(metadata)),
        localidade=insert_absent(star.localidade, places_from_metadata(metadata), PLACE_KEY),
    )


def insert_members(star: Star, rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(new places, new dimension members, accepted cells with ids) of resolved rows.

    ``rows`` is read several times, so it should be a written table.
    """
    place_ids, places = give_ids(star.localidade, places_of(rows), PLACE_KEY)
    dimension_ids, dimensions = give_ids(star.dimensao, dimensions_of(rows), MEMBER_KEY)
    cells = accepted(rows).drop("nc", "nn", "d1c", "d1n", *DIMENSION_COLUMNS)
    return places, dimensions, with_member_ids(cells, place_ids, dimension_ids)


def load_batch(
    star: Star,
    observations: DataFrame,
    frequencies: DataFrame | None = None,
    revisions: str = "latest",
    keep_flags: bool = False,
) -> Load:
    """Members, cells and supersession of a batch, all cubes in one job.

    ``observations`` has tabela_sidra_id, modificacao and raw columns, from
    landed documents or any other source. A row without a modification is
    rejected and counted. The raw rows are read once: their
    resolved form is staged, and later steps read the staged columns they need. Loading the
    same batch again changes nothing. Cubes without a value row take no part.
    ``keep_flags`` stores the sentinel texts instead of dropping their cells.
    """
    nulled = [c for c in RAW_COLUMNS if not (keep_flags and c == "V")]
    rows = staged(
        resolve_by_content(
            null_sentinels(complete_raw(observations), nulled),
            star.periodo,
            star.tabela_sidra,
            frequencies,
            keep_names=True,
        ),
        "resolved",
    )
    places, dimensions, cells = insert_members(star, rows)
    touched = touched_partitions(accepted(rows))
    merged = staged(merge_touched(star.dados, cells, revisions, touched), "merged")
    kept = untouched(star.dados, touched)
    return Load(
        new_places=places,
        new_dimensions=dimensions,
        merged=merged,
        rejects=rejected(rows),
        report=load_report(rows, merged),
        star=star._replace(
            localidade=star.localidade.unionByName(places),
            dimensao=star.dimensao.unionByName(dimensions),
            dados=kept.select(*FACT_COLUMNS).unionByName(
                merged.select(*FACT_COLUMNS)
            ),
        ),
    )


def save_metadata(
    spark: SparkSession,
    path: str,
    metadata: DataFrame,
    load_date: Column | None = None,
) -> Star:
    """T11 on a stored star.

    New places are appended, then catalogue and periods change together: they are
    written as a new version, and one step makes it the current one. A reader sees
    the tables before or after it. Should the driver be lost on the way, loading the
    metadata again does what is left, and members keep the ids they got.
    """
    before = read_star(spark, path)
    with scratch(spark):
        _, new_places = give_ids(before.localidade, places_from_metadata(metadata), PLACE_KEY)
        described = {
            "tabela_sidra": upsert_catalogue(before.tabela_sidra, metadata, load_date),
            "periodo": upsert_periods(before.periodo, periods_from_metadata(metadata)),
        }
        append_members(new_places, f"{path}/localidade", "localidade")
        replace_described(spark, path, described)
    return read_star(spark, path)


def append_members(rows: DataFrame, path: str, table: str) -> None:
    with freed_shuffles(rows.sparkSession):
        rows.select(*STAR_SCHEMAS[table].fieldNames()).write.mode("append").options(**PACKED).parquet(path)


def save_load(load: Load, path: str) -> None:
    """Publish a load: new members are appended, touched partitions replaced.

    Members come first and stay even if the fact step fails. Every step can be
    repeated: after a failure the same batch is simply loaded again.
    """
    append_members(load.new_places, f"{path}/localidade", "localidade")
    append_members(load.new_dimensions, f"{path}/dimensao", "dimensao")
    write_facts(load.merged, f"{path}/dados")


def load_into(
    spark: SparkSession,
    path: str,
    observations: DataFrame,
    frequencies: DataFrame | None = None,
    revisions: str = "latest",
    keep_flags: bool = False,
    batch_id: str | None = None,
) -> DataFrame:
    """Load a batch into a stored star; returns the report.

    A batch with an id leaves its report in the star as the last step of its load.
    Sent again, it is recognised by it: nothing is read, and that report is returned.
    A load that failed on the way left none and is done again.
    """
    if batch_id is not None and (done := report_of(spark, path, batch_id)) is not None:
        return done
    with scratch(spark):
        load = load_batch(
            read_star(spark, path), observations, frequencies, revisions, keep_flags
        )
        report = stage(load.report, "report")
        save_load(load, path)
    if batch_id is not None:
        folder = _report_path(path, batch_id)
        report.write.mode("overwrite").parquet(folder)
        commit(spark, folder)
    return report


def _report_path(path: str, batch_id: str) -> str:
    return f"{path}/loads/{hashlib.md5(batch_id.encode()).hexdigest()}"


def report_of(spark: SparkSession, path: str, batch_id: str) -> DataFrame | None:
    """The report of a batch that was loaded under this id, if it was."""
    folder = _report_path(path, batch_id)
    return spark.read.parquet(folder) if is_committed(spark, folder) else None


def load_documents(
    spark: SparkSession, path: str, docs: DataFrame, **options
) -> DataFrame:
    """T10 from landed documents: (file_path, value) rows into a stored star."""
    keep_flags = options.get("keep_flags", False)
    rows = observations_from_documents(docs, keep_flags=keep_flags)
    return load_into(spark, path, rows, **options)


def load_planned(
    spark: SparkSession, path: str, docs: DataFrame, descriptors: DataFrame, **options
) -> DataFrame:
    """T10 from landed documents and the descriptors of the plan that asked for them."""
    keep_flags = options.get("keep_flags", False)
    rows = observations_by_descriptor(docs, descriptors, keep_flags=keep_flags)
    return load_into(spark, path, rows, **options)
