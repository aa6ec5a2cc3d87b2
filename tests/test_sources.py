"""Tagged files, whole documents and sinks."""

import bz2
import gzip
import random

import pytest
from pyspark.sql import functions as F

from brevia.plans import catalog
from brevia.sources import documents as src
from brevia.sources import sinks, tagged
from brevia.session import checkpoint_dir, materialise, scratch_path


def raws(df):
    return [r.raw for r in df.orderBy("pos").collect()]


def test_stray_end_tag_and_open_tail(spark, tmp_path):
    text = "x</sentence><sentence id=1>a</sentence> <sentence id=2>b</sentence> <sentence id=3>c"
    (tmp_path / "doc.txt").write_text(text)
    want = ["<sentence id=1>a</sentence>", "<sentence id=2>b</sentence>"]
    assert raws(tagged.read_tagged(spark, str(tmp_path))) == want
    assert len(raws(tagged.read_tagged(spark, str(tmp_path), strict=False))) == 3
    df = spark.createDataFrame([(0, text)], "doc_id long, text string")
    assert raws(tagged.tagged_records(df, "doc_id", "text")) == want


@pytest.mark.parametrize("pack, suffix", [(gzip.compress, "gz"), (bz2.compress, "bz2")])
def test_compressed_files_keep_their_last_record(spark, tmp_path, pack, suffix):
    text = "".join(f"<sentence id={i}>é > {i}</sentence>" for i in range(100))
    for name, tail in (("whole", ""), ("feed", "\n"), ("open", "<sentence id=x>y"), ("edge", "<sentence id=x>")):
        (tmp_path / f"{name}.txt.{suffix}").write_bytes(pack((text + tail).encode()))
    rows = tagged.read_tagged(spark, str(tmp_path)).groupBy("name").count().collect()
    assert {r["name"].split(".")[0]: r["count"] for r in rows} == dict.fromkeys(("whole", "feed", "open", "edge"), 100)


def test_a_terminated_last_record_stays_and_text_outside_is_skipped(spark, tmp_path):
    (tmp_path / "a.txt").write_text("junk é\n<sentence id='1'>x\ny</sentence>")
    (tmp_path / "b.txt").write_text("<sentence id='1'>z</sentence>\ntail é")
    got = tagged.read_tagged(spark, str(tmp_path))
    assert sorted(r.raw[13:].replace("\n", "") for r in got.collect()) == [
        "'1'>xy</sentence>",
        "'1'>z</sentence>",
    ]
    assert {r.name for r in got.collect()} == {"a.txt", "b.txt"}


def test_records_that_straddle_splits_come_once(spark, tmp_path):
    rng = random.Random(1)
    bodies = [f"{i} " + "w" * rng.randint(1, 150) for i in range(300)]
    for f in range(3):
        part = bodies[f::3]
        text = "".join(f"<sentence id={i}>{b}</sentence>\n" for i, b in enumerate(part))
        (tmp_path / f"d{f}.txt").write_text(text + ("<sentence id=open>" if f == 1 else ""))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100")
    try:
        df = tagged.read_tagged(spark, str(tmp_path))
        assert df.rdd.getNumPartitions() > 20
        rows = df.orderBy("name", "pos").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    want = [b for f in range(3) for b in bodies[f::3]]
    assert [r.raw.split(">", 1)[1].removesuffix("</sentence>") for r in rows] == want


def test_files_with_one_base_name_stay_two_documents(spark, tmp_path):
    for folder in ("x", "y"):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "same.txt").write_text(f"text {folder}\nmore")
    docs = src.read_documents(spark, f"{tmp_path}/*")
    assert docs.count() == 2 and docs.select("name").distinct().count() == 1
    assert src.sentences(docs).count() == 4


@pytest.mark.parametrize("own", [True, False])
def test_document_files_keep_rows_with_one_id_apart(spark, tmp_path, monkeypatch, own):
    rows = [(5, "a\nb"), (5, "a\nb"), (5, ""), (-7, "é\n"), (None, "none"), (3, None)]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(src, "spread", lambda df: df.coalesce(1))
    monkeypatch.setattr(sinks, "FOLDER_FILES", 2)
    if not own:
        monkeypatch.setattr(sinks, "_document_files", lambda root: (_ for _ in ()).throw(AssertionError))
        monkeypatch.setattr(sinks, "MOUNTED", ())
    found = [tuple(r) for r in catalog.document_file_round_trip(spark, str(tmp_path)).collect()]
    key = lambda r: (str(r[0]), r[1])
    assert sorted(found, key=key) == sorted([(i, x or "") for i, x in rows], key=key)


def test_document_files_lie_in_folders_of_bounded_size(spark, tmp_path):
    rows = spark.range(3000).selectExpr("id AS doc_id", "'x' AS text").coalesce(1)
    assert sinks.write_documents(rows, str(tmp_path / "d")) == 3000
    sizes = [len(list(x.iterdir())) for x in (tmp_path / "d").iterdir()]
    assert sorted(sizes) == [3000 - 2 * 1024, 1024, 1024]
    assert sinks.write_documents(rows.where("doc_id < 0"), str(tmp_path / "none")) == 0
    assert src.read_documents(spark, f"{tmp_path}/none/*").count() == 0


def test_pair_and_line_sinks_replace_their_folder(spark, tmp_path):
    path = str(tmp_path / "out")
    for n in (1, 2):
        df = spark.createDataFrame([("a@b=c/d", n)], "term string, n long")
        sinks.write_pairs(df, "term", "n", path)
    assert src.read_lines(spark, path).collect() == [("a@b=c/d", "2")]
    sinks.write_lines(df, "term", path)
    assert [r.value for r in spark.read.text(path).collect()] == ["a@b=c/d"]


def test_vector_sink(spark, tmp_path):
    rows = [("d", 7, 0.5), ("d", 2, 1.0), ("e", 0, 2.0)]
    df = spark.createDataFrame(rows, "doc_id string, idx int, w double")
    sinks.write_vectors(df, 10, str(tmp_path / "v"))
    got = {r.doc_id: r.features for r in sinks.read_vectors(spark, str(tmp_path / "v")).collect()}
    assert got["d"].size == 10 and list(got["d"].indices) == [2, 7]
    assert list(got["d"].values) == [1.0, 0.5] and list(got["e"].indices) == [0]


def test_materialise_uses_the_named_folder(spark):
    df = materialise(spark.range(3).withColumn("x", F.lit("y")), "t")
    assert df.count() == 3
    assert checkpoint_dir(spark) in df.inputFiles()[0]
    assert scratch_path(spark, "t") != scratch_path(spark, "t")


def test_an_unset_folder_is_temporary_in_local_mode_only(monkeypatch):
    class Context:
        master, folder = "local[2]", None

        def getCheckpointDir(self):
            return self.folder

        def setCheckpointDir(self, path):
            self.folder = path

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda key, default: default)

    first = checkpoint_dir(Session)
    assert first == checkpoint_dir(Session) == Session.sparkContext.folder
    Session.sparkContext = Context()
    Session.sparkContext.master = "local-cluster[2,1,1024]"
    with pytest.raises(RuntimeError):
        checkpoint_dir(Session)
    Session.sparkContext.master = "spark://host:7077"
    with pytest.raises(RuntimeError):
        checkpoint_dir(Session)


@pytest.mark.parametrize("text, n", [("a", 1), ("a\nb", 2), ("", 1), ("a\n", 2)])
def test_sentences_are_lines(spark, text, n):
    docs = spark.createDataFrame([(0, text)], "doc_id long, text string")
    assert src.sentences(docs).count() == n


def test_files_of_documents_are_listed_by_the_tasks(spark, tmp_path, monkeypatch):
    rows = [(i, f"text {i}\n" * (i % 4)) for i in range(40)] + [(3, "again"), (None, None), (99, "żółć 😀")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(sinks, "FOLDER_FILES", 7)
    found = catalog.document_file_round_trip(spark, str(tmp_path))
    assert found.inputFiles() == []  # the driver knows no file
    want = [(i, t or "") for i, t in rows]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(want, key=str)
    folder = str(tmp_path / "d")
    sinks.write_documents(spark.createDataFrame(rows, "doc_id long, text string"), folder)
    with open(f"{folder}/{0:06d}-{0:06d}/doc_id=500", "wb") as out:
        out.write(b"no utf-8: \xff\xfe")
    columns = [F.regexp_replace("doc_id", "^file:/*", "/").alias("doc_id"), "name", F.hex("text").alias("text")]
    a, b = (sorted(df.select(*columns).collect(), key=str) for df in (src.read_folders(spark, folder, 5), src.read_documents(spark, f"{folder}/*")))
    assert a == b and len(a) == len(rows) + 1
