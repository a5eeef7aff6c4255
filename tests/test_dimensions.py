import datetime as dt
import hashlib

from pyspark.sql import functions as F

from cubestar.operators.dimensions import (
    distinct_dimensions,
    distinct_period_codes,
    distinct_places,
    insert_absent,
    periods_from_metadata,
    places_from_metadata,
    unique_tables,
    upsert_catalogue,
    upsert_periods,
)
from cubestar.operators.lookups import (
    dimension_lookup,
    period_by_code,
    period_by_group,
    period_lookup,
    place_lookup,
    resolve_by_content,
    resolve_cells,
)
from cubestar.operators.surrogates import MEMBER_KEY, PLACE_KEY, with_content_keys
from cubestar.plans.load import load_metadata
from cubestar.schema import empty_star
from helpers import D1, D2, cube, metadata, observations, values


def test_places_are_cleaned_and_first_row_names_them(spark):
    rows = observations(
        spark,
        {"NC": "6", "D1C": "100.0", "D1N": " old ", "modificacao": D1},
        {"NC": "N6", "D1C": " 100", "D1N": " new ", "modificacao": D2},
        {"NC": None, "D1C": None, "D1N": None, "NN": None},
        {"D1C": "200", "V": None},
    )
    got = sorted(values(distinct_places(rows), "nc", "d1c", "nn", "d1n"))
    assert got == [("", "", "", ""), ("N6", "100", "Town", "new")]


def test_file_and_position_break_ties(spark):
    rows = [
        {"D1N": "third", "file_path": "b", "pos": 1},
        {"D1N": "second", "file_path": "a", "pos": 12},
        {"D1N": "zfirst", "file_path": "a", "pos": 2},
    ]
    df = observations(spark, *rows, extra=("file_path", "pos"))
    assert values(distinct_places(df), "d1n") == [("zfirst",)]
    assert values(distinct_places(df.repartition(5)), "d1n") == [("zfirst",)]


def test_dimensions_null_codes_equal_but_not_empty(spark):
    rows = observations(
        spark, {"MC": None}, {"MC": None, "D2N": "Var"}, {"MC": ""}, {"MN": None, "D2N": None, "D4C": "8", "D4N": None},
        {"D2C": None},
    )
    df = distinct_dimensions(rows)
    assert df.count() == 3
    assert values(df.filter("d4c = '8'"), "mn", "d2n", "d4n") == [("", "", None)]
    kept = distinct_dimensions(rows, keep_unmatchable=True)
    assert values(kept.filter("d2c = ''"), "mc") == [("10",)]


def test_period_codes(spark):
    rows = observations(spark, {}, {"D3C": None}, {"D3C": ""}, {"D3C": "202002", "V": None}, {"D3C": "202003"})
    assert sorted(values(distinct_period_codes(rows), "codigo")) == [("202001",), ("202003",)]


def stored_places(spark, candidates):
    return insert_absent(empty_star(spark).localidade, candidates, PLACE_KEY)


def stored_members(spark, candidates):
    return insert_absent(empty_star(spark).dimensao, candidates, MEMBER_KEY)


def test_existing_member_wins(spark):
    old = stored_places(spark, distinct_places(observations(spark, {"D1N": "kept"})))
    new = distinct_places(observations(spark, {"D1N": "ignored"}, {"D1C": "2", "D1N": "added"}))
    assert sorted(values(insert_absent(old, new, PLACE_KEY), "id", "d1n")) == [(1, "kept"), (2, "added")]


def test_catalogue_keeps_first_values(spark):
    first = upsert_catalogue(empty_star(spark).tabela_sidra, metadata(spark, cube("1")), F.lit("2024-01-01").cast("date"))
    renamed = cube("1", frequency="anual", periods=("2020",))
    renamed["nome"] = "Renamed"
    second = upsert_catalogue(first, metadata(spark, renamed, cube("2")), F.lit("2024-02-02").cast("date"))
    got = {r.id: r for r in second.collect()}
    assert (got["1"].nome, got["1"].periodicidade, got["1"].ultima_atualizacao) == ("Cube 1", "mensal", dt.date(2024, 1, 1))
    assert "Renamed" in got["1"].metadados
    assert got["2"].ultima_atualizacao == dt.date(2024, 2, 2)


def test_period_attributes_are_replaced(spark):
    first = upsert_periods(empty_star(spark).periodo, periods_from_metadata(metadata(spark, cube("1"))))
    changed = cube("2", periods=("202002", "202003"))
    for p in changed["periodos"]:
        p["trimestre"] = 1
    merged = upsert_periods(first, periods_from_metadata(metadata(spark, changed)))
    assert sorted(values(merged, "codigo", "trimestre")) == [("202001", None), ("202002", 1), ("202003", 1)]
    ids = dict(values(merged, "codigo", "id"))
    assert {c: ids[c] for c in ("202001", "202002")} == dict(values(first, "codigo", "id")) and ids["202003"] == 3


def test_places_from_metadata_use_data_level_codes(spark):
    described = cube()
    described["localidades"] = [
        {"id": "100", "nome": "A", "nivel": {"id": "6", "nome": "Town"}},
        {"id": "100", "nome": "again", "nivel": {"id": "N6", "nome": "Town"}},
    ]
    places = places_from_metadata(metadata(spark, described))
    assert values(places, "nc", "d1c", "d1n") == [("N6", "100", "A")]
    assert values(places, "key") == values(distinct_places(observations(spark, {})), "key")


def test_repeated_cube_ids(spark):
    df = spark.createDataFrame([("5",), ("5",), ("6",)], "tabela_sidra string")
    assert unique_tables(df).count() == 2


def periods(spark):
    return spark.createDataFrame(
        [("1", "200702", "mensal", ["a"]), ("2", "200702", "semestral", ["b"]), ("3", "200701", "mensal", None)],
        "id string, codigo string, frequencia string, literals array<string>",
    )


#: Of the two periods 200702, the one whose content key is smaller.
SMALLEST = min(
    ("1", "2"), key=lambda i: hashlib.md5(f"v6:200702v5:1|1:{'ab'[int(i) - 1]}".encode()).hexdigest()
)


def frequencies(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "frequencia string")


def test_ambiguous_period_codes(spark):
    p = periods(spark)
    assert dict(values(period_by_code(p, frequencies(spark, "mensal")), "codigo", "periodo_id")) == {"200702": "1", "200701": "3"}
    assert dict(values(period_by_code(p, frequencies(spark, "semestral")), "codigo", "periodo_id")) == {"200702": "2"}
    unfiltered = {r.codigo: (r.periodo_id, r.hits) for r in period_by_code(p).collect()}
    # The smallest content key, whatever the ids.
    assert unfiltered == {"200702": (SMALLEST, 2), "200701": ("3", 1)}


def test_period_groups(spark):
    pairs = spark.createDataFrame([("bimestral", "mensal"), ("bimestral", "semestral")], "periodicidade string, frequencia string")
    got = {(r.grupo, r.codigo): (r.periodo_id, r.hits) for r in period_by_group(periods(spark), pairs).collect()}
    assert got == {
        ("bimestral", "200702"): (SMALLEST, 2), ("bimestral", "200701"): ("3", 1),
        ("", "200702"): (SMALLEST, 2), ("", "200701"): ("3", 1),
    }


def test_lookups_restrict(spark):
    places = stored_places(spark, distinct_places(observations(spark, {}, {"D1C": "2"})))
    nothing = places.filter("false")
    assert place_lookup(places, nothing).count() == 0
    assert place_lookup(places, places.filter("d1c = '2'")).count() == 1
    dims = stored_members(spark, distinct_dimensions(observations(spark, {}, {"D4C": "8"}, {"D2C": "6"})))
    assert dimension_lookup(dims, dims.filter("d4c = '8'")).count() == 2
    lookup = period_lookup(periods(spark), frequencies(spark, "200701").withColumnRenamed("frequencia", "codigo"))
    assert values(lookup, "literals", "periodo_id") == [([], "3")]


def test_reject_reasons_in_order(spark):
    star = load_metadata(empty_star(spark), metadata(spark, cube("1")))
    known = observations(spark, {}, {"D1C": "2", "MC": None})
    places, dims = stored_places(spark, distinct_places(known)), stored_members(spark, distinct_dimensions(known))
    batch = observations(
        spark,
        {"V": "ok"},
        {"D1C": "2.0", "MC": None, "V": "ok null"},
        {"V": None, "D1C": "unknown"},
        {"D1C": "unknown", "D2C": None, "V": "place"},
        {"D2C": None, "D3C": "190001", "V": "dimension"},
        {"D4C": "unknown", "V": "dimension too"},
        {"D3C": "190001", "V": "period"},
        {"D3C": None, "V": "no period"},
    )
    got = dict(values(resolve_cells(batch, places, dims, star.periodo, star.tabela_sidra), "v", "reject_reason"))
    assert got == {
        "ok": None, "ok null": None, "place": "localidade", "dimension": "dimensao",
        "dimension too": "dimensao", "period": "periodo", "no period": "periodo",
    }


def test_content_resolution_equals_lookup(spark):
    star = load_metadata(empty_star(spark), metadata(spark, cube("1")))
    batch = observations(
        spark, {}, {"D1C": "2"}, {"MC": None, "D4C": None}, {"D2C": None}, {"D3C": "1"}, {"V": "..."},
        {"tabela_sidra_id": "not described", "D3C": "202002"},
    )
    star = star._replace(
        localidade=stored_places(spark, distinct_places(batch)),
        dimensao=stored_members(spark, distinct_dimensions(batch)),
    )
    by_lookup = with_content_keys(
        star, resolve_cells(batch, star.localidade, star.dimensao, star.periodo, star.tabela_sidra)
    )
    told = {"localidade_key": "localidade_id", "dimensao_key": "dimensao_id"}
    by_content = with_content_keys(
        star._replace(localidade=None, dimensao=None),
        resolve_by_content(batch, star.periodo, star.tabela_sidra),
    ).withColumnsRenamed(told)
    columns = by_content.columns
    def everything(df):
        return sorted(map(str, values(df, *columns)))

    assert everything(by_lookup) == everything(by_content)
