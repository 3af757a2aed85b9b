import pytest
from pyspark.sql import types as T

from sparkwright.operators.shape import drop_blank_rows, leak_guard
from sparkwright.session import scratch_root
from sparkwright.sources import files as X


def test_csv_keeps_line_ends_quotes_and_nulls(spark, tmp_path):
    rows = [(1, 'say "hi", all', 2.5), (2, None, None), (3, "plain", 0.0)]
    df = spark.createDataFrame(rows, "id long, s string, x double")
    X.sink_csv(df, str(tmp_path / "a"), header=False, null_token="?")
    back = X.scan_csv(spark, str(tmp_path / "a"), df.schema, header=False, null_token="?")
    assert sorted(map(tuple, back.collect())) == rows


def test_csv_inference(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b\n1,x\n2,y\n")
    df = X.scan_csv(spark, str(tmp_path / "t.csv"))
    assert isinstance(df.schema["a"].dataType, T.IntegerType)


def test_labelled_corpus_and_mail_parts(spark, tmp_path):
    mails = {
        "spam/1": b"Subject: x\nContent-Type: text/plain\n\nbuy now",
        "easy_ham 2/2": b"Subject: y\nContent-Type: multipart/mixed; boundary=B\n\n--B\n"
        b"Content-Type: image/png\n\nxx\n--B\nContent-Type: text/html\n\n<p>hello</p>\n--B--\n",
        "hard_ham/3": b"Content-Type: application/pdf\n\nzz",
        "spam_2/cmds": b"mv a b",
        "other/4": b"Subject: z\n\nnot listed",
    }
    for name, body in mails.items():
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(body)
    files = X.scan_labelled_corpus(spark, str(tmp_path))
    got = sorted(
        (r["filename"].split("/")[-1], r["label"], r["text"]) for r in X.mail_text_part(files).collect()
    )
    assert got == [("1", 1, "buy now"), ("2", 0, "<p>hello</p>"), ("3", 0, None)]


def test_word_vectors_drop_malformed_lines(spark, tmp_path):
    (tmp_path / "v.txt").write_text("cat 1 2.5\nbad 1\ndog -1 0 3\nowl 0 -2e-1\n")
    got = {r["word"]: r["vector"] for r in X.scan_word_vectors(spark, str(tmp_path / "v.txt"), 2).collect()}
    assert got.keys() == {"cat", "owl"} and got["owl"] == pytest.approx([0, -0.2])


def test_blank_rows(spark):
    df = spark.createDataFrame([("a", 1), ("", 2), (" ", 3), (None, 4), ("b", None)], "t string, n int")
    assert [r["t"] for r in drop_blank_rows(df, "t").collect()] == ["a"]


def test_leak_guard():
    leak_guard(["a", "b"], "y")
    with pytest.raises(ValueError, match="y"):
        leak_guard(["a", "y"], "y")


def test_scratch_follows_the_session_setting(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert scratch_root(spark) == (named or scratch_root(spark))


class _Session:
    """A session on a cluster master, with or without the shared folder."""

    def __init__(self, folder):
        self.conf = {"spark.checkpoint.dir": folder} if folder else {}
        self.sparkContext = self
        self.master = "yarn"

    def getConf(self):
        return self.conf


def test_scratch_never_falls_back_to_a_local_folder_on_a_cluster():
    assert scratch_root(_Session("hdfs:///shared")) == "hdfs:///shared"
    with pytest.raises(RuntimeError):
        scratch_root(_Session(None))
