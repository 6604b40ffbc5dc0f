"""One-document JSON payloads read by byte ranges give the rows of a reader that sees them whole."""

import json
import random

import pytest

from atlaspanel.sources import json_ranges, readers


@pytest.fixture
def ranges_of(spark):
    """Cut files into ranges of so many bytes."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}

    def cut(n):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(n))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")

    yield cut
    for k, v in before.items():
        spark.conf.set(k, v)


def rows(df):
    return sorted(map(str, map(tuple, df.collect())))


ODD_TEXT = ["plain", "a}b", 'q"q', "back\\slash", "[{", "}{]},{", 'end\\"}', "", "é}ü", "\n}\t", "{" * 5, "}" * 9]


def records(rng, n):
    return [
        {"countryIsoCode": rng.choice(["AFG", "NAM", None]), "country": rng.choice(ODD_TEXT), "year": rng.choice([2000, "2001", None]), "indicatorCode": rng.choice(ODD_TEXT), "value": rng.choice([0.5, 3, "x}", None])}
        for _ in range(n)
    ]


@pytest.mark.parametrize("size, indent", [(60, None), (150, 2), (3000, None)])
def test_records_of_one_array(spark, tmp_path, ranges_of, size, indent):
    rng = random.Random(size)
    for i in range(2):
        (tmp_path / f"p{i}.json").write_text(json.dumps(records(rng, 25), indent=indent, ensure_ascii=bool(i)) + "\n" * i)
    whole = rows(readers.read_point_records(spark, str(tmp_path), multi_line=True))
    ranges_of(size)
    assert rows(readers.read_point_records(spark, str(tmp_path), by_ranges=True)) == whole
    assert len(whole) == 50


@pytest.mark.parametrize("size", [90, 400])
def test_records_keep_the_order_of_the_payload(spark, tmp_path, ranges_of, size):
    for name in ("a", "b"):
        (tmp_path / f"{name}.json").write_text(json.dumps([{"countryIsoCode": name, "country": "x" * (i % 40), "year": i, "indicatorCode": "}" * (i % 3), "value": i} for i in range(20)]))
    ranges_of(size)
    got = readers.read_point_records(spark, str(tmp_path), ordered=True, by_ranges=True).orderBy("ingest_seq").collect()
    assert [(r.countryIsoCode, int(r.year)) for r in got] == [(n, i) for n in "ab" for i in range(20)]
    assert len({r.ingest_seq for r in got}) == 40


@pytest.mark.parametrize("size", [71, 100_000])
def test_nested_maps(spark, tmp_path, ranges_of, size):
    rng = random.Random(size)
    values = {ind: {c: {str(y): rng.choice([1.5, None, "x}y"]) for y in range(1990, 1990 + rng.randrange(6))} for c in ("USA", "D}E", 'q"{')} for ind in ("BCA", "G}{", "NG")}
    values["EMPTY"], values["NONE"] = {}, {"USA": None}
    (tmp_path / "a.json").write_text(json.dumps({"api": {"version": "1", "deep": {"a": {"b": {"1": 2}}}}, "values": values}, indent=1))
    (tmp_path / "b.json").write_text(json.dumps({"values": {"BCA": {"FRA": {"2000": 7}}}, "after": [1, {"x": {"y": {}}}]}))
    (tmp_path / "c.json").write_text(json.dumps({"values": {}}))
    whole = rows(readers.read_nested_map(spark, str(tmp_path), multi_line=True))
    ranges_of(size)
    assert rows(readers.read_nested_map(spark, str(tmp_path), by_ranges=True)) == whole


@pytest.mark.parametrize("size", [97, 700])
def test_parallel_arrays(spark, tmp_path, ranges_of, size):
    docs = [{"dimensions": {"REF_AREA": f"C{i}", "X": "}"}, "period": [str(2000 + j) for j in range(i % 5)], "value": [0.5 * j for j in range(i % 4)], "note": "]}" * (i % 3)} for i in range(40)]
    (tmp_path / "a.json").write_text(json.dumps({"series": {"num": 1, "docs": docs}, "datasets": {"docs": [{"a": 1}]}}))
    (tmp_path / "b.json").write_text(json.dumps({"series": {"docs": []}}))
    whole = rows(readers.read_parallel_arrays(spark, str(tmp_path), multi_line=True))
    ranges_of(size)
    assert rows(readers.read_parallel_arrays(spark, str(tmp_path), by_ranges=True)) == whole


def test_unreadable_documents_are_rejects(spark, tmp_path, ranges_of):
    good = json.dumps([{"countryIsoCode": "AFG", "country": "A", "year": 2000, "indicatorCode": "hdi", "value": 1}] * 3)
    (tmp_path / "a.json").write_text(good)
    (tmp_path / "b.json").write_text("<html>an error page</html>")
    (tmp_path / "c.json").write_text(good[:-2] + ', {"value": 12')  # ends within a record
    (tmp_path / "d.json").write_text(good[:-1] + ",")  # ends between records
    (tmp_path / "e.json").write_text('[{"countryIsoCode": "AFG", "value": nonsense}]')
    (tmp_path / "f.json").write_text("")
    ranges_of(60)
    got = readers.read_point_records(spark, str(tmp_path), by_ranges=True, ordered=True).collect()
    bad = sorted(r.value for r in got if r.countryIsoCode is None)
    assert sum(r.countryIsoCode == "AFG" and r.value == "1" for r in got) >= 8
    assert any("<html>" in b for b in bad) and any("nonsense" in b for b in bad) and any(b.startswith("unfinished document") and b.endswith("d.json") for b in bad)
    assert any('"value": 12' in b for b in bad) and not any(r.value == "12" for r in got)


def test_one_array_is_read_by_many_tasks(spark, tmp_path, ranges_of):
    """A large single array is split evenly, with the same rows."""
    n = 60_000
    with open(tmp_path / "big.json", "w") as f:
        f.write("[")
        for i in range(n):
            f.write(("," if i else "") + json.dumps({"countryIsoCode": f"C{i % 190}", "country": "Land } of " + "x" * (i % 50), "year": 2000 + i % 20, "indicatorCode": "hdi", "value": i}))
        f.write("]")
    size = (tmp_path / "big.json").stat().st_size
    ranges_of(size // 8 + 1)
    df = readers.read_point_records(spark, str(tmp_path), by_ranges=True)
    per_task = [r["n"] for r in json_ranges.fragments(spark, str(tmp_path)).groupBy("start").count().withColumnRenamed("count", "n").collect()]
    assert len(per_task) == 8 and max(per_task) < 2 * min(per_task)
    assert df.count() == n
    assert rows(df.agg({"value": "sum"})) == rows(spark.range(n).selectExpr("CAST(sum(id) AS DOUBLE)"))


def test_a_string_longer_than_ranges(spark, tmp_path, ranges_of):
    value = '}{,"' * 200
    (tmp_path / "a.json").write_text(json.dumps([{"countryIsoCode": "AFG", "value": value}, {"countryIsoCode": "NAM", "value": "}"}]))
    ranges_of(100)
    got = readers.read_point_records(spark, str(tmp_path), by_ranges=True).collect()
    assert sorted((r.countryIsoCode, r.value) for r in got) == [("AFG", value), ("NAM", "}")]
