"""The commands on files in a folder, and first rows of equal ones."""

from pyspark.sql import functions as F

from folioflow.__main__ import main
from folioflow.operators import history, resolution

PAGE = '<html><head><title>{t}</title><p>doi: <a>10.1/{k}</a></p></head><body><div id="abstract"><p>Short {k}.</p></div><div id="sections"><h2>One</h2><p>Text {k}.</p></div></body></html>'
NATURE = '<html><head><meta name="dc.publisher" content="Nature Publishing Group"><title>A | Nature</title></head><body><span class="c-bibliographic-information__value">https://doi.org/10.1038/{k}</span><div class="main-content"><h2>1 Start</h2><p>First {k}.</p></div></body></html>'


def folder(path, template, n):
    path.mkdir()
    for k in range(n):
        (path / f"a{k}.html").write_text(template.format(k=k, t=f"Title {k}"))
    return str(path)


def test_parse(spark, tmp_path):
    source = folder(tmp_path / "in", NATURE, 3)
    (tmp_path / "in" / "broken.html").write_text("<p>nothing")
    (tmp_path / "skip.txt").write_text("10.1038/1\n")
    main(["parse", "--input", source, "--output", str(tmp_path / "out"), "--skip", str(tmp_path / "skip.txt")])
    rows = spark.read.parquet(f"{tmp_path}/out/articles")
    assert {r.doi for r in rows.collect()} == {"10.1038/0", "10.1038/2"} and rows.where("type = 'PARAGRAPH'").count() == 2
    assert [r.source.split("/")[-1] for r in spark.read.parquet(f"{tmp_path}/out/failed").collect()] == ["broken.html"]


def test_index_twice(spark, tmp_path, capsys):
    source = folder(tmp_path / "in", PAGE, 2)
    run = lambda *more: main(["index", "--input", source, "--store", str(tmp_path / "store"), "--record", str(tmp_path / "record"), *more])
    run()
    run()
    (tmp_path / "in" / "a1.html").unlink()
    run("--cleanup", "full")
    said = [eval(line) for line in capsys.readouterr().out.splitlines() if line.startswith("{")]
    assert said == [{"added": 4, "updated": 0, "skipped": 0, "deleted": 0}, {"added": 0, "updated": 0, "skipped": 4, "deleted": 0}, {"added": 0, "updated": 0, "skipped": 2, "deleted": 2}]
    assert spark.read.parquet(str(tmp_path / "store")).count() == 2


def test_plain_and_vectors(spark, tmp_path):
    source = folder(tmp_path / "in", PAGE, 2)
    main(["plain", "--input", source, "--store", str(tmp_path / "plain"), "--full-text"])
    assert spark.read.parquet(str(tmp_path / "plain")).count() == 2
    main(["plain", "--input", source, "--store", str(tmp_path / "vectors"), "--vectors"])
    got = spark.read.parquet(str(tmp_path / "vectors"))
    assert got.count() == 4 and got.where(F.size("embedding") == 64).count() == 4


def test_first_of_equal_rows(spark):
    df = spark.createDataFrame([(3, "x", "c"), (1, "x", "a"), (2, None, "n"), (5, "y", "y")], "k int, t string, more string")
    assert sorted((r.k, r.t, r.more) for r in history.hashed(df, "t", "k").collect()) == [(1, "x", "a"), (2, None, "n"), (5, "y", "y")]
    said = spark.createDataFrame([(2, "Do  it."), (1, "do it"), (3, "Other")], "k int, t string")
    assert sorted(r.k for r in resolution.distinct_instructions(said, "t", "k").collect()) == [1, 3]
    assert sorted(r.t for r in resolution.distinct_instructions(said, "t").collect()) == ["Do  it.", "Other"]
