import random

import pyarrow as pa

from tests.llm.helpers import ODD, documents, prose
from tillbook.llm import templates

ITEM = "On that day Anna buys 12 apples at the market in Rome for 3 dollars and then Anna sells 5 of them to Bob"
BENCHMARK = [(1, ITEM), (2, "Ok."), (3, None), (4, ""), (None, "plain words without any slot that are long enough to match"), (6, "seven words only are in this item")]


def benchmark(spark, rows=BENCHMARK):
    return spark.createDataFrame([(i, t, 0) for i, t in rows], "item_id long, text string, key int")


def found(spark, rows, **more):
    return sorted(map(str, ((r.doc_id, r.item_id, r.exact, r.consistent, r.contaminated) for r in templates.find(documents(spark, rows), benchmark(spark), **more).collect())))


CASES = [
    (1, f"before. {ITEM} after that"),
    (2, "so it was: on that day Maria buys 40 apples at the market in Paris for 7 euros and then Maria sells 9 of them to Tom"),
    (3, "on that day Maria buys 40 apples at the market in Paris for 7 euros and then Peter sells 9 of them to Tom"),
    (4, "Ok."),
    (5, "that is Ok."),
    (6, "nothing of the kind 12 apples at the market"),
    (None, "well, plain words without any slot that are long enough to match"),
    (8, "SEVEN words only are in this item, it says"),
    (9, "seven words only are in that item"),
]


def test_literal_and_changed_questions(spark):
    got = found(spark, CASES + ODD)
    verdicts = {eval(r)[:2]: eval(r)[2:] for r in got}
    assert verdicts[1, 1] == (True, True, True)
    assert verdicts[2, 1] == (False, True, True)
    assert verdicts[3, 1] == (False, False, False), "Maria in one place and Peter in the other is another question"
    assert verdicts[4, 2] == (True, True, True) and (5, 2) not in verdicts
    assert verdicts[None, None] == (True, True, True)
    assert verdicts[8, 6] == (True, True, True)
    assert {k[0] for k in verdicts} == {1, 2, 3, 4, None, 8}


def test_large_benchmarks_are_joined_alike(spark):
    assert found(spark, CASES + ODD, broadcast_windows=0) == found(spark, CASES + ODD)


def test_against_every_alignment(spark):
    """Planted items, whole and in part, against a scan of all windows of all documents."""
    rng = random.Random(4)
    items = [(i, prose(rng, rng.randint(5, 30), 80) + (" 7 km" if i % 3 else "")) for i in range(30)]
    rows = []
    for i in range(150):
        words = prose(rng, rng.randint(0, 40), 80).split()
        if i % 2:
            own = rng.choice(items)[1].split()
            cut = rng.randint(0, len(own) // 2)
            words[5:5] = own[cut:]
        rows.append((i, " ".join(words)))
    got = {(r.doc_id, r.item_id) for r in templates.find(documents(spark, rows), benchmark(spark, items)).where("exact").collect()}
    expected = set()
    for doc_id, text in rows:
        for item_id, item in items:
            own, n = item.split(), min(8, len(item.split()))
            grams = {tuple(own[k : k + n]) for k in range(len(own) - n + 1)}
            words = text.split()
            if any(tuple(words[k : k + n]) in grams for k in range(len(words) - n + 1)):
                expected.add((doc_id, item_id))
    assert got == expected and len(got) > 30


def test_types_of_words():
    own = templates.Templates(pa.array(["Hello there. Then Anna met Émile with 5 km, two apples and 12kg."]))
    kinds = {int(templates.NUMBER): "N", int(templates.NAME): "P", int(templates.UNIT): "U"}
    assert "".join(kinds.get(int(t), ".") for t in own.token) == "...P.P.NUN..N"


def test_clean_keeps_the_rest(spark):
    docs = documents(spark, CASES + ODD)
    kept = templates.clean(docs, benchmark(spark))
    assert kept.columns == docs.columns
    bad = {f for i, (d, t) in enumerate(CASES) if d in (1, 2, 4, None, 8) for f in [i]}
    assert sorted(r.shard for r in kept.collect()) == [i for i in range(len(CASES) + len(ODD)) if i not in bad], "a null doc_id is judged by its own text"


def test_empty_tables(spark):
    docs = documents(spark, CASES)
    assert templates.find(docs.limit(0), benchmark(spark)).count() == 0
    assert templates.find(docs, benchmark(spark, [])).count() == 0
    assert templates.clean(docs, benchmark(spark, [])).count() == len(CASES)


def test_one_literal_window_is_no_contamination(spark):
    """Rows of numbers and stock phrases that an item shares with clean documents; longer runs and whole items still count."""
    stock = "Which of the following statements is true about the water cycle in dry places near the coast of a large island"
    items = [(1, "Go on with the row 1 2 3 4 5 6 7 8 and name the rule"), (2, stock), (3, "1 2 3 4 5 6 7 8"), (4, "the sum of 1 2 3 4 5 6")]
    rows = [
        (1, "a table has 1 2 3 4 5 6 7 8 as its columns"),
        (2, "tell me which of the following statements is true about horses"),
        (3, "quiz: which of the following statements is true about the water cycle in dry weather"),
        (4, f"quiz: {stock} today"),
        (5, "1 2 3 4 5 6 7 8"),
        (6, "we want the sum of 1 2 3 4 5 6 here"),
    ]
    got = {(r.doc_id, r.item_id): (r.exact, r.contaminated) for r in templates.find(documents(spark, rows), benchmark(spark, items)).collect()}
    assert got[1, 1] == got[1, 3] == got[2, 2] == (True, False)
    assert got[3, 2] == got[4, 2] == (True, True), "13 words in a row, and all of it"
    assert got[5, 3] == (True, True) and got[5, 1] == (True, False)
    assert got[6, 4] == (True, True)
    assert sorted(r.doc_id for r in templates.clean(documents(spark, rows), benchmark(spark, items)).collect()) == [1, 2]


def test_questions_asked_anew(spark):
    """Other names and numbers in more or fewer words, and names that open sentences."""
    items = [
        (1, "Tom has 5 apples. Tom buys 3 more. How many apples does Tom have?"),
        (2, "Last week the farm of Anna sold 250 boxes of pears for 4 dollars a box and then Anna paid 30 workers"),
        (3, "Tom baked 20 cakes for the fair. Tom sold 7 cakes before noon. What was left over?"),
        (4, "Each of the boats at the pier holds seven people and costs forty dollars an hour to rent"),
        (5, "On the first day the red team ran around the big old lake and on the next day the blue team slept"),
    ]
    rows = [
        (1, "quiz: Maria has 12 apples. Maria buys 9 more. How many apples does Maria have?"),
        (2, "Last week the farm of Mary Ann sold 1,250 boxes of pears for 3.5 dollars a box and then Mary Ann paid 1,030 workers"),
        (3, "Maria baked 3 cakes for the fair. Maria sold 9,000 cakes before noon. What was left over?"),
        (4, "each of the boats at the pier holds twenty two people and costs two hundred dollars an hour to rent"),
        (5, "on the first day the red team ran around the big but old lake and on the next day the blue team slept"),
        (6, "Maria has 12 apples. Peter buys 9 more. How many apples does Susan have?"),
        (7, "Last week the farm of Mary Ann sold 1,250 boxes of pears for 3.5 dollars a box and then Bob Lee paid 1,030 workers"),
    ]
    for more in ({}, {"broadcast_windows": 0}):
        got = {(r.doc_id, r.item_id) for r in templates.find(documents(spark, rows), benchmark(spark, items), **more).where("contaminated").collect()}
        assert got == {(k, k) for k in range(1, 6)}


def test_words_that_make_one_token():
    own = templates.Templates(pa.array(["Anna Lee paid 1,250.5 dollars. Bob met Anna, Tom O'Neil and twenty five men.", "Anna"]))
    kinds = {int(templates.NUMBER): "N", int(templates.NAME): "P", int(templates.UNIT): "U"}
    shape = lambda way: "".join(kinds.get(int(t), ".") for t in own.read(way).token)
    assert shape("names") == "P.NU..PP.N.." and shape("openers") == "P.NUP.PP.N.P"
