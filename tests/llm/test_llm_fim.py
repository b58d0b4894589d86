"""Fill-in-the-middle against a plain version; its SQL is compared in test_llm_rows."""

import hashlib
import re

import numpy as np
from cases import awkward_rows, sha
from hypothesis import given, settings
from hypothesis import strategies as st

from bucketlens.llm import fim

TOKEN = re.compile(r"[A-Za-z]+|[^A-Za-z]")


def plain_fim(doc_id, text, percent=90, spm_percent=20):
    """n, form, characters of prefix and middle, output, from the definition."""
    text = text or ""
    tokens = TOKEN.findall(text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(tokens)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or "<P>" in text or "<S>" in text or "<M>" in text or h[2] % 100 >= percent:
        return n, "plain", None, None, text
    prefix, middle, suffix = ("".join(x) for x in (tokens[:a], tokens[a:b], tokens[b:]))
    if h[3] % 100 < spm_percent:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_awkward_documents(awkward):
    rows = [r[:2] for r in awkward_rows()]
    assert rows_of(fim.fim_documents(awkward)) == sorted(((i, *plain_fim(i, t)) for i, t in rows), key=repr)
    got = rows_of(fim.fim_query(awkward))
    expected = [(i, *plain_fim(i, t)[:4], sha(plain_fim(i, t)[4]), sha(t or "")) for i, t in rows]
    assert got == sorted(expected, key=repr)


def test_marks_in_texts_and_around_cuts(spark):
    texts = ["<P>", "a<S>b", "x <M", "<", ">P><<S", "<S" * 50, "p>P><P <S <M >" * 9, "é<P>", "<<<P<S<M>>" * 3, "ab" * 400]
    rows = [(i * 13 + k, t) for i in range(30) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    assert rows_of(fim.fim_documents(docs)) == sorted(((i, *plain_fim(i, t)) for i, t in rows), key=repr)
    assert {r[-1] for r in rows_of(fim.fim_query(docs))} == {sha(t) for t in texts}


def test_all_cut_and_rebuilt(spark, corpus):
    cut = fim.fim_documents(corpus, percent=100, spm_percent=50)
    rebuilt = cut.select("doc_id", "form", fim.restored(cut["form"], cut["output"]).alias("text"))
    assert rows_of(rebuilt.select("doc_id", "text")) == rows_of(corpus.selectExpr("doc_id", "coalesce(text, '') AS text"))
    forms = {r.form: r["count"] for r in rebuilt.groupBy("form").count().collect()}
    assert abs(forms["spm"] - forms["psm"]) < 200


def test_empty_table_and_other_ids(spark, nothing):
    assert rows_of(fim.fim_query(nothing)) == []
    named = spark.createDataFrame([("k1", "some words here"), (None, "more")], "doc_id STRING, text STRING").selectExpr("*", "1 AS n", "text AS form")
    assert rows_of(fim.fim_documents(named)) == sorted([("k1", *plain_fim("k1", "some words here")), (None, *plain_fim(None, "more"))], key=repr)


def test_long_texts_in_groups_of_their_own(monkeypatch, awkward):
    expected = rows_of(fim.fim_documents(awkward))
    texts = [(r[1] or "").encode() for r in awkward_rows()]
    assert list(fim._groups(texts, 10))[0] == (0, 1)
    cut = []
    for begin, end in fim._groups(texts, 2_000):
        cut += zip(*fim.cut_texts([r[0] for r in awkward_rows()[begin:end]], texts[begin:end], 1, 90, 20))
    assert sorted(((r[0], *c[:4], c[4].decode()) for r, c in zip(awkward_rows(), cut)), key=repr) == expected


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="aZ é日<P>\n1", max_size=80), min_size=1, max_size=6), st.integers(0, 90))
def test_counts_and_cuts(texts, k):
    group = fim.Texts([t.encode() for t in texts])
    tokens = [TOKEN.findall(t) for t in texts]
    assert group.tokens().tolist() == [len(t) for t in tokens]
    n = np.array([k % (len(t) + 1) for t in tokens])
    ends = group.after(n)
    starts = group.begins
    assert (ends - starts).tolist() == [len("".join(t[:m]).encode()) for t, m in zip(tokens, n)]
    assert group.characters(starts, ends).tolist() == [len("".join(t[:m])) for t, m in zip(tokens, n)]


def test_ranks_over_many_words():
    draw = np.random.default_rng(4)
    classes = draw.integers(0, 4, 1_000).astype(np.uint8)
    matrix, at = fim.WaveletMatrix(classes), np.arange(1_001)
    for symbol in range(4):
        assert matrix.rank(symbol, at).tolist() == np.concatenate([[0], np.cumsum(classes == symbol)]).tolist()
