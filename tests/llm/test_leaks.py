import random

from headway.llm import decontaminate


def found(spark, docs, items):
    docs, items = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    return {(r.doc_id, r.item_id): r.literal for r in decontaminate.leaks(docs, items).collect()}


def test_names_that_open_sentences_glued_units_and_items_of_slots(spark):
    tom = "Tom has 5 apples. Tom gives 2 to Ann. Tom eats 1. How many apples does Tom have left?"
    crate = "a crate of 48kg goes 5km by cart and 12km by boat before it is weighed"
    numbers = "12 7 33 5 81 4 19 60 Anna Ben 44 2"
    items = [(1, tom), (2, crate), (3, numbers)]
    docs = [(1, "Some text. " + tom.replace("Tom", "Ben").replace("5", "9") + " More text."),
            (2, "so " + crate.replace("48", "31").replace("5km", "6km").replace("12", "20") + " again"),
            (3, "so " + crate.replace("48kg", "31 kg").replace("5km", "6 lb").replace("12km", "20 lb")),
            (4, "they were " + numbers + " in this order"), (5, "they were 13 8 34 6 82 5 20 61 Carl Dora 45 3"),
            (6, tom), (7, "Tom has 5 apples. Ben gives 2 to Ann. Carl eats 1. How many apples does Dan have left?")]
    assert found(spark, docs, items) == {(1, 1): False, (2, 2): False, (3, 2): False, (4, 3): True, (6, 1): True}


def test_words_put_in_and_left_out(spark):
    words = [f"w{i}" for i in range(38)]
    item = " ".join(words)
    swapped = " ".join(words[19:] + words[:19])
    sums = "the shop sells 12 pears to Anna in the early morning hours and then another 12 pears go over to Bert who waits outside of the gate"
    docs = [(1, " ".join(words[:19] + ["extra"] + words[19:])), (2, " ".join(words[:18] + words[20:])),
            (3, "before " + " ".join(words[:12] + ["one"] + words[12:26] + words[27:]) + " after"), (4, swapped),
            (5, " ".join(words[:10])), (6, sums.replace("12", "31").replace("another", "yet another")),
            (7, sums.replace("then another 12", "then yet another 13"))]
    got = found(spark, docs, [(1, item), (2, sums)])
    assert got == {(1, 1): True, (2, 1): True, (3, 1): True, (6, 2): False}


def chain(item, doc, band):
    """Longest chain of equal windows with ascending places, all alignments within ``band`` of one, by plain search."""
    size = decontaminate.WINDOW
    places = {tuple(doc[i:i + size]): i for i in range(len(doc) - size + 1)}
    hits = [(at, places[tuple(item[at:at + size])]) for at in range(len(item) - size + 1) if tuple(item[at:at + size]) in places]
    most = 0
    for middle in {place - at for at, place in hits}:
        near = [(at, place) for at, place in hits if abs(place - at - middle) <= band]
        best = []
        for i, (at, place) in enumerate(near):
            best.append(1 + max((best[j] for j in range(i) if near[j][0] < at and near[j][1] < place), default=0))
        most = max([most, *best])
    return most, len(item) - size + 1


def test_chains_against_plain_search(spark):
    rng = random.Random(5)
    items = [(i, [f"i{i}x{k}" for k in range(rng.randrange(12, 60))]) for i in range(12)]
    docs = []
    for i, words in items:
        for n in range(8):
            doc, at = [], 0
            while at < len(words):
                take = rng.randrange(4, 30)
                doc += words[at:at + take] + [f"d{n}y{at}z{k}" for k in range(rng.choice([0, 0, 1, 2, 20]))]
                at += take + rng.choice([0, 0, 1, 2])
            docs.append((len(docs), doc, i, words))
    got = found(spark, [(d, " ".join(doc)) for d, doc, _, _ in docs], [(i, " ".join(words)) for i, words in items])
    want = {}
    for d, doc, i, words in docs:
        n, of = chain(words, doc, decontaminate.BAND)
        if n >= of * decontaminate.SHARE:
            want[d, i] = True
    assert got == want and 10 < len(want) < len(docs)
