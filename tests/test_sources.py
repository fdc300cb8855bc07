"""Readers and writers on small files of each format."""

import bz2
import json

import pytest

from pyspark.sql import functions as F

from corpusloom.sources import readers, writers


def test_labelled_tsv(spark, tmp_path):
    path = tmp_path / "r.txt"
    path.write_text('id\tdocument\tlabel\n1\tgood "film"\t1\n2\t\t0\n3\tbad\n4\tfine\t0\n', encoding="utf-8")
    rows = readers.read_labelled_tsv(spark, str(path)).orderBy("id").collect()
    assert [tuple(r) for r in rows] == [("1", 'good "film"', 1), ("4", "fine", 0)]
    assert readers.read_labelled_tsv(spark, str(path), with_label=False).columns == ["id", "text"]


def test_review_json(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"review": " x ", "movie_id": "1"}, {"review": " ", "movie_id": "1"}]))
    (tmp_path / "b.json").write_text(json.dumps([{"review": "y", "movie_id": "2"}]))
    rows = readers.read_review_json(spark, str(tmp_path)).orderBy("text").collect()
    assert [tuple(r) for r in rows] == [("x", "1"), ("y", "2")]


def test_qa_json(spark, tmp_path):
    path = tmp_path / "qa.json"
    qas = [{"question": "q1", "answers": [{"text": "a1"}, {"text": "a2"}]}, {"question": "q2", "answers": []}]
    path.write_text(json.dumps({"data": [{"paragraphs": [{"context": "c", "qas": qas}]}]}))
    rows = readers.read_qa_json(spark, str(path)).orderBy("article", "paragraph", "line").collect()
    assert [r["text"] for r in rows] == ["c", "q1 a1", "q1 a2"]


def test_wiki_xml_bz2(spark, tmp_path):
    page = "<page><title>{}</title><ns>{}</ns><id>{}</id>{}<revision><id>9</id><text>{}</text></revision></page>"
    pages = page.format("A", 0, 1, "", "''x'' b:") + page.format("B", 1, 2, "", "talk") + page.format(
        "C", 0, 3, '<redirect title="A" />', "#REDIRECT"
    )
    path = tmp_path / "dump.xml.bz2"
    path.write_bytes(bz2.compress(f"<mediawiki>{pages}</mediawiki>".encode()))
    rows = readers.read_wiki_xml(spark, str(path), min_tokens=2).collect()
    assert [(r["doc_id"], r["title"], r["tokens"]) for r in rows] == [(1, "A", ["x", "b"])]
    assert readers.read_wiki_xml(spark, str(path)).count() == 0


def test_wiki_markup(spark):
    from corpusloom.functions.text import wiki_text

    cases = {
        "a {{x|{{y|{{z}}}}}} b": "a  b", "{{open a": "{{open a", "{| t\n| c {| d |} |}e": "e", "[[a|b]] [[c]] [[d|e|f]]": "b c f",
        "[[File:x.png|thumb|see [[a|this]] now]]": "see this now", "[[File:x.png]]|[[Category:y|z]]": "|", "<ref name='q'>n</ref>x<ref n/>y": "xy",
        "<!-- a\nb -->c": "c", "[http://e.org/a b c] [http://e.org/]": "b c ", "<b>x</b>&amp;&nbsp;y": "x& y", None: "", "": "",
        "{{" * 50 + "x" + "}}" * 50 + "y": "y",
    }
    df = spark.createDataFrame([(c,) for c in cases], "t string")
    assert {r[0]: r[1] for r in df.select("t", wiki_text(F.col("t"))).collect()} == cases


def test_blankline_docs(spark, tmp_path):
    path = tmp_path / "d.txt"
    path.write_text("\n\na\nb\n\n\nc\n")
    rows = readers.read_blankline_docs(spark, str(path)).orderBy("doc_no", "sent_no").collect()
    assert [tuple(r) for r in rows] == [(0, 0, "a"), (0, 1, "b"), (1, 0, "c")]


def test_line_order_over_splits(spark, tmp_path):
    path = tmp_path / "v.txt"
    path.write_text("".join(f"word{i}\n" for i in range(20000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        vocab = readers.read_vocab(spark, str(path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(vocab) == 20000 and all(r["token"] == f"word{r['id']}" for r in vocab)


def test_lm_vocab(spark, tmp_path):
    path = tmp_path / "v.txt"
    path.write_text("</S>\n<S>\n!!!MAXTERMID\n<UNK>\na\n")
    rows = readers.read_lm_vocab(spark, str(path), require_specials=True).orderBy("id").collect()
    assert [r["token"] for r in rows] == ["</S>", "<S>", "<UNK>", "a"]
    path.write_text("a\n")
    with pytest.raises(ValueError):
        readers.read_lm_vocab(spark, str(path), require_specials=True)


def test_vectors_and_vocab_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a", [1.5, -2.0])], "key string, vec array<double>")
    for layout, sep in (("space", " "), ("tab", "\t")):
        writers.write_vectors(df, str(tmp_path / layout), sep=sep)
        assert readers.read_vectors(spark, str(tmp_path / layout), layout).collect() == df.collect()
    (tmp_path / "ft.vec").write_text("1 2\na 1.5 -2.0\n")
    assert readers.read_vectors(spark, str(tmp_path / "ft.vec"), "header+space").collect() == df.collect()


def test_pairs_and_analogies(spark, tmp_path):
    (tmp_path / "p.csv").write_text("a,b,1.5\n")
    assert [tuple(r) for r in readers.read_similarity_pairs(spark, str(tmp_path / "p.csv")).collect()] == [("a", "b", 1.5)]
    (tmp_path / "q.txt").write_text("# head\n\na b c d\nx y\nv w x y z\n")
    got = [tuple(r) for r in readers.read_analogies(spark, str(tmp_path / "q.txt")).collect()]
    assert got == [("a", "b", "c", "d"), (None, None, None, "y"), (None, None, None, "z")]
    (tmp_path / "t.tab").write_text("a\tb\tc\td\na\tb\n#\tb\tc\td\n")
    got = [tuple(r) for r in readers.read_analogies(spark, str(tmp_path / "t.tab"), "\t").collect()]
    assert got == [("a", "b", "c", "d"), ("#", "b", "c", "d")]


def test_line_shards(spark, tmp_path):
    out = tmp_path / "shards"
    writers.write_line_shards(spark.range(25).selectExpr("cast(id as string) as text").coalesce(1), str(out), 10)
    sizes = sorted(len(p.read_text().split()) for p in out.glob("part-*"))
    assert sizes == [5, 10, 10]


def test_files_for_workers(spark):
    paths = spark.createDataFrame([(f"f{i}",) for i in range(7)], ["path"])
    got = lambda mode: [r["worker"] for r in readers.assign_files(paths, 3, mode).orderBy("path").collect()]
    assert got("strided") == [0, 1, 2, 0, 1, 2, 0]
    assert got("contiguous") == [0, 0, 1, 1, 2, 2, 2]


def test_tokenized_cache_builds_once(spark, tmp_path):
    calls = []
    build = lambda df: calls.append(1) or df
    for _ in range(2):
        assert writers.tokenized_cache(spark.range(3), str(tmp_path / "c"), build).count() == 3
    assert calls == [1]
