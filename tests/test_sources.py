import json

from pyspark.sql import functions as F

from cubestar.functions.requests import request_key
from cubestar.operators.expand import dimension_members
from cubestar.sources.documents import (
    explode_documents,
    files_per_table,
    observations_from_documents,
    read_documents,
    read_latest,
)
from cubestar.sources.export import export_members
from cubestar.sources.landing import landed_names, split_plan, with_request_key
from cubestar.sources.metadata import catalogue_rows, period_rows, read_metadata
from helpers import cube, metadata, values


def land(folder, name, rows):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(json.dumps(rows, indent=2), encoding="utf-8")


def test_document_rows(spark, tmp_path):
    rows = [{"metadata": "x"}, {"V": 1, "Other": "a"}, {"V": 2, "Other": "b"}, {"V": "...", "Other": "-"}]
    land(tmp_path / "t-1", "t-1_p-2020_f-C@2005-01-05.json", rows)
    read = explode_documents(read_documents(spark, str(tmp_path)), extra_columns=["Other"])
    assert values(read.orderBy("pos"), "V", "Other") == [("1", "a"), ("2", "b"), (None, None)]
    kept = explode_documents(read_documents(spark, str(tmp_path)), keep_flags=True)
    assert values(kept.orderBy("pos"), "V") == [("1",), ("2",), ("...",)]


def test_documents_without_rows(spark, tmp_path):
    land(tmp_path / "t-2", "t-2_p-1@a.json", [{"NC": "header_only"}])
    land(tmp_path / "t-2", "t-2_p-2@a.json", [])
    land(tmp_path / "t-2", "metadados.json", {"id": "2"})
    docs = read_documents(spark, str(tmp_path))
    assert docs.count() == 2
    assert explode_documents(docs).count() == 0


def test_broken_document_stops_the_job(spark, tmp_path):
    import pytest

    (tmp_path / "t-1_p-1@a.json").write_text("[{]", encoding="utf-8")
    with pytest.raises(Exception):
        explode_documents(read_documents(spark, str(tmp_path))).collect()


def test_latest_file_per_request(spark, tmp_path):
    def doc(v):
        return [{"V": "Value"}, {"V": v}]

    folder = tmp_path / "t-1"
    land(folder, "t-1_p-1@2024-01-01.json", doc("old"))
    land(folder, "t-1_p-1@2024-02-01.json", doc("new"))
    land(folder, "t-1_p-2@2023-01-01.json", doc("only"))
    land(folder, "t-1_p-3.json", doc("undated"))
    land(folder, "t-1_p-3@0.json", doc("dated"))
    land(folder, "a@b@1.json", doc("two"))
    land(folder, "a@b@2.json", doc("two later"))
    land(folder, "metadados.json", {"id": "1"})
    got = {r.V for r in read_latest(spark, str(tmp_path)).collect()}
    assert got == {"new", "only", "dated", "two later"}


def test_observations_know_cube_and_date(spark, tmp_path):
    land(tmp_path / "t-77", "t-77_p-202001_f-A_n6-all@2024-05-06.json", [{}, {"V": "3", "D3C": "202001", "NC": 6}])
    docs = read_documents(spark, str(tmp_path))
    row = observations_from_documents(docs).first()
    assert (row.tabela_sidra_id, str(row.modificacao), row.V, row.NC) == ("77", "2024-05-06", "3", "6")
    assert values(files_per_table(docs), "tabela_sidra_id", "n_files") == [("77", 1)]


def named(spark, sql):
    df = spark.sql(sql)
    c = F.col
    return df.select(
        request_key(c("a"), c("t"), c("p"), c("v"), c("k"), c("f"), c("m"))
    ).first()[0]


def test_request_names(spark):
    assert named(
        spark,
        "SELECT '123' a, map('6', array('12345', '67890')) t, array('202001', '202002') p,"
        " array('allxp') v, map('', CAST(array() AS ARRAY<STRING>)) k, 'C' f, '2005-01-05' m",
    ) == "t-123_p-202001,202002_f-C_n6-12345,67890_v-allxp_c-@2005-01-05.json"
    assert named(
        spark,
        "SELECT '999' a, map('6', CAST(array() AS ARRAY<STRING>)) t, array('202101') p,"
        " CAST(NULL AS ARRAY<STRING>) v, map('10', array('1', '2')) k, 'C' f, '2021-01-01' m",
    ) == "t-999_p-202101_f-C_n6-all_c10-1,2@2021-01-01.json"
    assert named(
        spark,
        "SELECT '9' a, map('7', array('1'), '6', array('2')) t, array('1') p,"
        " CAST(array() AS ARRAY<STRING>) v, map() k, 'A' f, DATE'2021-01-01' m",
    ) == "t-9_p-1_f-A_n7-1_n6-2@2021-01-01.json"


def test_landed_and_pending(spark, tmp_path):
    plan = with_request_key(
        spark.sql(
            "SELECT '4' AS tabela_sidra, map('6', CAST(array() AS ARRAY<STRING>)) AS territories,"
            " array(p) AS periods, array('all') AS variables, map('2', array('1')) AS classifications,"
            " 'A' AS format, DATE'2020-01-01' AS modificacao FROM (SELECT explode(array('1', '2')) AS p)"
        )
    )
    land(tmp_path / "t-4", "t-4_p-1_f-A_n6-all_v-all_c2-1@2020-01-01.json", [{}, {"V": "1"}])
    landed, pending = split_plan(plan, landed_names(spark, str(tmp_path)))
    assert values(landed, F.col("periods")[0]) == [("1",)]
    assert values(pending, F.col("periods")[0]) == [("2",)]


def test_metadata_file(spark, tmp_path):
    folder = tmp_path / "t-1"
    folder.mkdir()
    (folder / "metadados.json").write_text(json.dumps(cube(classes=[(81, [1, 2])]), indent=1))
    read = read_metadata(spark, str(folder / "metadados.json"))
    assert values(period_rows(read), "codigo", "ano", "mes") == [("202001", 2020, 1), ("202002", 2020, 2)]
    text = json.loads(catalogue_rows(read).first().metadados)
    assert text["periodos"][0]["modificacao"] == "2024-01-01"
    assert text["periodos"][0]["trimestre"] is None
    assert text["classificacoes"][0]["categorias"][1]["id"] == "2"


def test_csv_export(spark, tmp_path):
    described = cube(variables=[{"id": "1", "nome": 'a "b", c', "unidade": " m "}])
    export_members(dimension_members(metadata(spark, described)), str(tmp_path / "out"))
    lines = [
        line
        for part in sorted((tmp_path / "out").glob("*.csv"))
        for line in part.read_text(encoding="utf-8").splitlines()
    ]
    assert lines == [
        "mc,mn,d2c,d2n,d4c,d4n,d5c,d5n,d6c,d6n,d7c,d7n,d8c,d8n,d9c,d9n",
        ', m ,1,"a ""b"", c",,,,,,,,,,,,',
    ]
