"""The merge truth table, the laws of a load, and stored stars."""

import json

import pytest
from pyspark.sql import functions as F

from cubestar.operators.facts import batch_cells
from cubestar.operators.lookups import period_match_ratio
from cubestar.plans.load import load_batch, load_into, load_metadata, save_metadata
from cubestar.schema import FACT_COLUMNS, empty_star
from cubestar.sources.star_tables import (
    create_star,
    read_star,
    refresh_star,
    register_star,
    star_of,
)
from cubestar.streaming.ingest import ingest
from helpers import D1, D2, D3, cube, metadata, observations, values


@pytest.fixture(scope="module")
def described(spark):
    return load_metadata(
        empty_star(spark),
        metadata(spark, cube("1"), cube("2", frequency="anual", periods=("2020",))),
    )


def facts(star):
    """(place, period, date, active, value) of every stored cell."""
    d = star.dados.alias("d")
    joined = d.join(star.localidade.alias("l"), F.col("d.localidade_id") == F.col("l.id")).join(
        star.periodo.alias("p"), F.col("d.periodo_id") == F.col("p.id")
    )
    rows = joined.select("d1c", "codigo", F.day("modificacao").alias("day"), "ativo", "v").collect()
    return sorted(tuple(r) for r in rows)


OLD = [
    {"D1C": "a", "V": "resent later", "modificacao": D1},
    {"D1C": "b", "V": "stored at d2", "modificacao": D2},
    {"D1C": "c", "V": "sent again at d1", "modificacao": D1},
    {"D1C": "d", "V": "revised old", "modificacao": D1},
    {"D1C": "e", "V": "withdrawn", "modificacao": D1},
    {"D1C": "f", "V": "other period", "modificacao": D1, "D3C": "202002"},
]
NEW = [
    {"D1C": "g", "V": "new at d2", "modificacao": D2},
    {"D1C": "h", "V": "new at d1", "modificacao": D1},
    {"D1C": "b", "V": "changed text", "modificacao": D2},
    {"D1C": "c", "V": "sent again at d1", "modificacao": D1},
    {"D1C": "d", "V": "revised new", "modificacao": D2},
]


@pytest.fixture(scope="module")
def stored(spark, described):
    return load_batch(described, observations(spark, *OLD)).star


def expected(revisions):
    rows = [
        ("g", "202001", 15, True, "new at d2"),
        ("h", "202001", 1, False, "new at d1"),
        ("b", "202001", 15, True, "stored at d2"),
        ("c", "202001", 1, False, "sent again at d1"),
        ("d", "202001", 1, False, "revised old"),
        ("e", "202001", 1, False, "withdrawn"),
        ("a", "202001", 1, False, "resent later"),
        ("f", "202002", 1, True, "other period"),
    ]
    if revisions == "latest":
        rows.append(("d", "202001", 15, True, "revised new"))
    return sorted(rows)


@pytest.mark.parametrize("revisions", ["latest", "keep_first"])
def test_merge_truth_table(spark, stored, revisions):
    load = load_batch(stored, observations(spark, *NEW), revisions=revisions)
    assert facts(load.star) == expected(revisions)
    report = load.report.first()
    added = 3 if revisions == "latest" else 2
    assert (report.staged, report.inserted) == (5, added)


@pytest.mark.parametrize("revisions", ["latest", "keep_first"])
def test_same_batch_twice_changes_nothing(spark, stored, revisions):
    once = load_batch(stored, observations(spark, *NEW), revisions=revisions).star
    again = load_batch(once, observations(spark, *NEW), revisions=revisions)
    assert facts(again.star) == expected(revisions)
    assert again.new_places.count() == again.new_dimensions.count() == 0
    report = again.report.first()
    assert (report.inserted, report.deactivated) == (0, 0)


def test_late_older_revision(spark, stored):
    newer = load_batch(stored, observations(spark, {"D1C": "a", "V": "newest", "modificacao": D3})).star
    late = observations(spark, {"D1C": "a", "V": "late", "modificacao": D2}, {"D1C": "z", "V": "late new", "modificacao": D2})
    latest = facts(load_batch(newer, late).star)
    assert ("a", "202001", 31, True, "newest") in latest
    assert ("a", "202001", 15, False, "late") in latest
    assert ("z", "202001", 15, False, "late new") in latest
    kept = facts(load_batch(newer, late, revisions="keep_first").star)
    assert ("z", "202001", 15, True, "late new") in kept
    assert not any(v == "late" for *_, v in kept)


def test_batch_prefers_newest_then_file_then_position(spark):
    rows = [
        ("k", D1, "a", 1, "older"), ("k", D2, "b", 1, "later file"),
        ("k", D2, "a", 10, "later row"), ("k", D2, "a", 2, "wins"),
    ]
    df = spark.createDataFrame(rows, "k string, modificacao date, file_path string, pos int, v string")
    cells = df.select(
        *(F.col("k").alias(c) for c in ("tabela_sidra_id", "localidade_id", "dimensao_id", "periodo_id")),
        "modificacao", "file_path", "pos", "v",
    )
    assert values(batch_cells(cells, "keep_first"), "v") == [("wins",)]
    assert sorted(values(batch_cells(cells, "latest"), "v")) == [("older",), ("wins",)]


def test_unknown_revision_mode(spark, stored):
    with pytest.raises(ValueError, match="revisions"):
        load_batch(stored, observations(spark, {}), revisions="newest")


def test_accepted_and_rejected_make_up_the_input(spark, described):
    batch = observations(
        spark, {}, {"D1C": "2", "V": "..."}, {"D1C": "3", "V": "-"}, {"D1C": "4", "V": "X"},
        {"D2C": None}, {"D2C": "..."}, {"D3C": "1"}, {"tabela_sidra_id": "2", "D3C": "2020"},
        {"tabela_sidra_id": "2", "D3C": "202001"}, {"tabela_sidra_id": "9", "V": "..."},
    )
    load = load_batch(described, batch)
    got = {r.tabela_sidra_id: r for r in load.report.collect()}
    assert set(got) == {"1", "2"}
    one, two = got["1"], got["2"]
    assert (one.staged, one.inserted, one.missing_places, one.missing_dimensions, one.missing_periods) == (2, 2, 0, 2, 1)
    assert (two.staged, two.missing_periods) == (1, 1)
    assert load.rejects.count() == 4
    assert load.star.dimensao.filter("d2c = ''").count() == 0
    ratio = period_match_ratio(batch, described.periodo, described.tabela_sidra)
    assert (("2", 2, 1)) in values(ratio, "tabela_sidra_id", "codes", "matched")


def test_flags_can_be_kept(spark, described):
    batch = observations(spark, {"V": "..."}, {"D1C": "2", "V": "-", "D4C": "-"})
    assert load_batch(described, batch).star.dados.count() == 0
    kept = load_batch(described, batch, keep_flags=True).star
    assert sorted(values(kept.dados, "v")) == [("-",), ("...",)]
    assert values(kept.dimensao.filter("d4c IS NULL"), "d2c") == [("5",)]


def test_partitioning_of_the_input_plays_no_part(spark, described):
    rows = [
        {"D1C": str(i % 4), "D1N": f"name {i}", "V": str(i), "modificacao": (D1, D2)[i % 2],
         "file_path": f"f{i % 3}", "pos": i}
        for i in range(40)
    ]
    batch = observations(spark, *rows, extra=("file_path", "pos"))
    results = set()
    for n in (1, 3, 7):
        star = load_batch(described, batch.repartition(n)).star
        results.add(str((facts(star), sorted(values(star.localidade, "d1c", "d1n")))))
    assert len(results) == 1


def test_frequency_table_picks_the_period(spark):
    monthly = cube("1", frequency="semestral", periods=("202001",))
    star = load_metadata(
        empty_star(spark), metadata(spark, monthly, cube("2", periods=("202001",)))
    )
    # The monthly period is told apart by its literals in a real description.
    assert star.periodo.count() == 1
    other = cube("2", periods=("202001",))
    other["periodos"][0]["literals"] = ["january 2020"]
    star = load_metadata(empty_star(spark), metadata(spark, monthly, other))
    batch = observations(spark, {}, {"tabela_sidra_id": "2"})

    def frequency_of(frequencies):
        loaded = load_batch(star, batch, frequencies).star
        joined = loaded.dados.join(loaded.periodo, F.col("periodo_id") == F.col("id"))
        return dict(values(joined, "tabela_sidra_id", "frequencia"))

    assert frequency_of(None) == {"1": "semestral", "2": "mensal"}
    pairs = spark.createDataFrame([("semestral", "mensal")], "periodicidade string, frequencia string")
    got = frequency_of(pairs)
    assert got["1"] == "mensal" and got["2"] in ("mensal", "semestral")


def store(spark, path):
    create_star(spark, path)
    save_metadata(spark, path, metadata(spark, cube("1"), cube("2")))
    return path


def test_stored_star_equals_the_pure_load(spark, tmp_path, stored):
    path = store(spark, str(tmp_path / "star"))
    load_into(spark, path, observations(spark, *OLD))
    report = load_into(spark, path, observations(spark, *NEW))
    assert facts(read_star(spark, path)) == expected("latest")
    assert report.first().inserted == 3
    load_into(spark, path, observations(spark, *NEW))
    assert facts(read_star(spark, path)) == expected("latest")


def test_other_partitions_are_not_rewritten(spark, tmp_path):
    path = store(spark, str(tmp_path / "star"))
    load_into(
        spark, path,
        observations(spark, {}, {"D3C": "202002"}, {"tabela_sidra_id": "2"}),
    )

    def files():
        return {str(f) for f in (tmp_path / "star" / "dados").rglob("*.parquet")}

    before = files()
    load_into(spark, path, observations(spark, {"V": "2", "modificacao": D2}))
    assert len(before & files()) == 2 and len(files()) == 3


def test_star_as_tables(spark, tmp_path, stored):
    path = store(spark, str(tmp_path / "star"))
    load_into(spark, path, observations(spark, *OLD))
    register_star(spark, path, "star_as_tables")
    assert spark.table("star_as_tables.dados").count() == len(OLD)
    assert set(FACT_COLUMNS) == set(spark.table("star_as_tables.dados").columns)
    load_into(spark, path, observations(spark, {"D1C": "a", "D3C": "202002"}))
    refresh_star(spark, "star_as_tables")
    assert facts(star_of(spark, "star_as_tables")) == facts(read_star(spark, path))


def test_landed_documents_are_streamed_once(spark, tmp_path):
    path = store(spark, str(tmp_path / "star"))
    landing = tmp_path / "landing" / "t-1"
    landing.mkdir(parents=True)

    def land(name, *places):
        rows = [{"V": "Value"}] + [
            {"NC": "6", "NN": "Town", "D1C": p, "D1N": p, "MC": "10", "MN": "Units", "D2C": "5",
             "D2N": "Var", "D3C": "202001", "V": "1"}
            for p in places
        ]
        (landing / name).write_text(json.dumps(rows))

    def run():
        query = ingest(spark, str(tmp_path / "landing"), path, str(tmp_path / "checkpoint"))
        query.awaitTermination()

    land("t-1_p-202001_f-A@2024-01-01.json", "a", "b")
    (landing / "metadados.json").write_text("{}")
    run()
    assert [r[:1] + r[3:] for r in facts(read_star(spark, path))] == [("a", True, "1"), ("b", True, "1")]
    land("t-1_p-202001_f-A@2024-02-01.json", "b")
    run()
    run()
    state = facts(read_star(spark, path))
    assert [(p, a) for p, _, _, a, _ in state] == [("a", False), ("b", False), ("b", True)]


def test_rows_without_a_modification_are_counted(spark, described):
    batch = observations(spark, {}, {"D1C": "2", "modificacao": None}, {"D1C": "3"})
    load = load_batch(described, batch)
    report = load.report.first()
    assert (report.staged, report.inserted, report.missing_modifications) == (2, 2, 1)
    assert load.star.dados.filter("ativo IS NULL OR modificacao IS NULL").count() == 0
    again = load_batch(load.star, batch).report.first()
    assert (again.inserted, again.deactivated) == (0, 0)


def test_documents_by_descriptor(spark, described, tmp_path):
    """The plan names cube and modification; the file names carry neither."""
    import json

    from cubestar.plans.load import load_planned
    from cubestar.sources.documents import observations_by_descriptor, observations_from_documents

    row = {"NC": "1", "D1C": "1", "D2C": "1", "D3C": "202001", "V": "5"}
    docs = spark.createDataFrame(
        [(f"folder/{n}.json", json.dumps([{}, {**row, "V": v}])) for n, v in (("a", "1"), ("b", "2"), ("c", "3"))],
        "file_path string, value string",
    )
    plan = spark.sql(
        "SELECT * FROM VALUES ('a.json', '1', DATE'2024-01-01'), ('b.json', '1', DATE'2024-01-02'),"
        " ('d.json', '1', DATE'2024-01-03') AS t(file_name, tabela_sidra_id, modificacao)"
    )
    rows = observations_by_descriptor(docs, plan)
    assert sorted(values(rows, "tabela_sidra_id", "V")) == [("1", "1"), ("1", "2")]
    named = spark.createDataFrame(
        [(f"t-1_p-1@{m}.json", json.dumps([{}, row])) for m in ("2024-01-01", "2024-01-01T08", "bad")],
        "file_path string, value string",
    )
    dates = [str(r.modificacao) for r in observations_from_documents(named).collect()]
    assert sorted(dates) == ["2024-01-01", "None", "None"]
    path = str(tmp_path / "star")
    create_star(spark, path)
    save_metadata(spark, path, metadata(spark, cube("1")))
    assert load_planned(spark, path, docs, plan).first().staged == 2


def test_a_load_that_failed_is_done_again(spark, tmp_path, monkeypatch):
    """Members are stored, facts are not: the repeat adds what is left, once."""
    from cubestar.plans import load as loading

    path = store(spark, str(tmp_path / "star"))
    batch = observations(spark, *OLD)
    monkeypatch.setattr(loading, "write_facts", lambda *a: (_ for _ in ()).throw(RuntimeError("driver lost")))
    with pytest.raises(RuntimeError):
        load_into(spark, path, batch, batch_id="stream#0")
    monkeypatch.undo()
    before = read_star(spark, path)
    assert before.dados.count() == 0 and before.localidade.count() == 6
    ids = dict(values(before.localidade, "d1c", "id"))
    report = load_into(spark, path, batch, batch_id="stream#0").first()
    star = read_star(spark, path)
    assert dict(values(star.localidade, "d1c", "id")) == ids and star.dados.count() == len(OLD)
    # Recognised by its id: nothing is read, whatever the batch holds now.
    again = load_into(spark, path, batch.where("false"), batch_id="stream#0").first()
    assert again == report and report.inserted == len(OLD)
    assert load_into(spark, path, batch.where("false"), batch_id="stream#1").count() == 0
