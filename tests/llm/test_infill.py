import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.helpers import ODD, documents
from tillbook.llm import infill


def plainly(doc_id, text, seed="1"):
    """The contract, on Python strings."""
    text = text or ""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        return n, "spm", a, b - a, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", a, b - a, f"<P>{prefix}<S>{suffix}<M>{middle}"


def bytes_of(text):
    return np.frombuffer(text.encode(), np.uint8)


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 10**6), st.text(alphabet="ab <>PSM\né中🙂", max_size=60), st.integers(1, 60))
def test_cuts_equal_plain_strings(doc_id, text, times):
    text = text * times  # over several blocks
    out, form, n, before, middle = infill.arranged(bytes_of(text), doc_id)
    assert (n, form, before, middle, out.decode()) == plainly(doc_id, text)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 5)), max_size=70))
def test_descent_equals_prefix_sums(counts):
    units, points = ([c[i] for c in counts] for i in (0, 1))
    tree = infill.Fenwick(np.array(units, np.int64), np.array(points, np.int64))
    for k in range(sum(units) + 1):
        block = next((i for i in range(len(units)) if sum(units[: i + 1]) > k), len(units))
        assert tree.descend(k) == (block, sum(units[:block]), sum(points[:block]))


def test_units_of_a_pattern():
    import regex

    text = "  one two,  drei 🙂🙂 vier " * 200
    rule = regex.compile(r"\S+\s*")
    units = rule.findall(text)
    found = infill.Text(bytes_of(text), rule)
    assert found.units == len(units) + 1, "what comes before the first match is a unit of its own"
    for k in (0, 1, 2, 7, 500, len(units), len(units) + 1):
        at, points = found.cut(k)
        want = 0 if k == 0 else 2 + len("".join(units[: k - 1]))
        assert points == want and at == len(text[:want].encode())


def test_rows_and_round_trip(spark):
    rows = ODD + [(i, f"text {i} é🙂 " * (i % 300)) for i in range(100, 400)] + [(8, "has <S> in it"), (9, "<<P>"), (11, "<<<>>>P>S>M>")]
    docs = documents(spark, rows)
    out = infill.infilled(docs)
    assert out.columns[: len(docs.columns)] == docs.columns
    got = out.select("doc_id", "text", "shard", "fim_units", "fim_form", "fim_prefix_chars", "fim_middle_chars", "fim_text", infill.restored(F.col("fim_text"), F.col("fim_form")).alias("back")).collect()
    assert len(got) == len(rows)
    for r in got:
        doc_id, text = rows[r.shard]
        assert r.doc_id == doc_id and r.text == (text or "") and r.back == r.text
        assert (r.fim_units, r.fim_form, r.fim_prefix_chars, r.fim_middle_chars, r.fim_text) == plainly(doc_id, text)
    assert {r.fim_form for r in got} == {"plain", "psm", "spm"}
    assert infill.infilled(docs.limit(0)).count() == 0


@pytest.mark.parametrize("sf", ["sf0.01"])
def test_query_on_the_given_table(spark, sf):
    rows = infill.op13_infill(spark, f"/root/testdata/{sf}").collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for r in rows:
        n, form, before, middle, out = plainly(r.doc_id, texts[r.doc_id])
        assert tuple(r) == (r.doc_id, n, form, before, middle, sha(out), sha(texts[r.doc_id] or ""))
