"""Fill-in-middle against a plain version on strings, and round trips."""

from __future__ import annotations

import hashlib
import re

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from rosterlake.llm import fill_in_middle as fim, oracle, queries
from parity import assert_same, connect

EDGE_TEXTS = [None, "", "a", "é", " \n", "<P>", "x <S> y", "<M", "ab\U0001f600cd", "word " * 50_000]
texts = st.text(alphabet="abZ é\n<PMS>/\U0001f600", max_size=40)
draws = st.lists(st.integers(0, 2**32 - 1), min_size=4, max_size=4)


def plain(text: str, h: list[int]) -> tuple:
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    n = len(units)
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = ("".join(part) for part in (units[:a], units[a:b], units[b:]))
    if h[3] % 100 < 20:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def draws_of(doc_id) -> list[int]:
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]


@settings(max_examples=300, deadline=None)
@given(texts, draws, st.sampled_from([1, 2, 3, 1 << 20]))
def test_arrange_and_restore(text, h, window):
    before = fim.WINDOW
    fim.WINDOW = window
    try:
        found = fim.arrange(text.encode(), h)
    finally:
        fim.WINDOW = before
    n, form, prefix, middle, output = plain(text, h)
    assert (found.n, found.form, found.prefix_chars, found.middle_chars) == (n, form, prefix, middle)
    assert found.table.joined() == output.encode()
    assert found.table.digest() == hashlib.sha256(output.encode()).hexdigest()
    assert fim.restore(output.encode(), form).joined() == text.encode()


@given(st.permutations(range(6)))
def test_inverse(order):
    assert [order[i] for i in fim.inverse(order)] == list(range(6))


def test_pieces_never_copy_the_text():
    text = b"one two three"
    table = fim.arrange(text, [2, 4, 0, 50]).table
    assert {piece.buffer for piece in table.pieces} == {0, 1}
    assert all(chunk.obj in (text, b"<P><M><S>") for chunk in table.chunks())


def test_cut_at_edges_and_beyond():
    table = fim.PieceTable([b"abc"], [fim.Piece(0, 0, 3)])
    table.cut(3)
    table.cut(0)
    assert [bytes(chunk) for chunk in table.chunks()] == [b"", b"abc", b""]
    with pytest.raises(IndexError):
        table.cut(4)


def test_output_without_its_marks_is_refused():
    with pytest.raises(ValueError):
        fim.restore(b"<P>a<S>b", fim.PSM)


def test_columns(spark):
    rows = [(i, text) for i, text in enumerate(EDGE_TEXTS * 3)] + [(3, "é"), (None, "no id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("form", F.lit("clash"))
    h = fim.draws_of(F.col("doc_id"))
    found = docs.select(
        "doc_id",
        "text",
        fim.fill_in_middle()("text", *h).alias("f"),
        fim.digests()("text", *h).alias("d"),
    ).withColumn("back", fim.restored_text()("f.output", "f.form"))
    for row in found.collect():
        n, form, prefix, middle, output = plain(row.text or "", draws_of(row.doc_id))
        assert tuple(row.f) == (n, form, prefix, middle, output)
        assert row.back == (row.text or "")
        sha = hashlib.sha256(output.encode()).hexdigest()
        back = hashlib.sha256((row.text or "").encode()).hexdigest()
        assert tuple(row.d) == (n, form, prefix, middle, sha, back)


def test_other_sentinels_and_rates(spark):
    marks = fim.Sentinels("<pre>", "<mid>", "<suf>")
    always = fim.Rates(plain_from=100, spm_below=100)
    docs = spark.createDataFrame([(1, "a <P> b"), (2, "<mid>")], "doc_id long, text string")
    found = docs.select(
        fim.fill_in_middle(marks, always)("text", *fim.draws_of(F.col("doc_id"))).alias("f")
    ).select("f.form", "f.output")
    first, second = found.collect()
    assert first.form == "spm" and first.output.startswith("<suf>") and "<mid>" in first.output
    assert tuple(second) == ("plain", "<mid>")


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert docs.select(fim.digests()("text", *fim.draws_of(F.col("doc_id")))).count() == 0


def test_query(spark, folder):
    found = queries.op11_piece_table_infilling(spark, folder)
    assert_same(found, connect(folder), oracle.ORACLES["op11_piece_table_infilling"])
