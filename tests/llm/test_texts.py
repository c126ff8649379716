import collections
import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from headway.llm import chat, decontaminate, line_templates, maxent, packing, queries, rules, web_pages

SMALL = "/root/testdata/sf0.001"


def texts(frame):
    return {r.doc_id: r.text for r in frame.select("doc_id", "text").collect()}


# Line templates

def test_recurring_lines_go_from_all_but_the_first(spark):
    rows = [(1, "start of one text\nJob 17 took 3 s on host a"), (2, "Job 99 took 12 s on host a\nsomething else is said here"),
            (3, "Job 5 took 1 s on host b\nJob 5 took 1 s on host b"), (4, None), (5, ""), (None, "Job 1 took 1 s on host b"), (6, "a b\na b"), (7, "a b")]
    got = {r.doc_id: (r.text, r.n_lines, r.n_dropped) for r in line_templates.without_recurring_lines(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1] == (rows[0][1], 2, 0)
    assert got[2] == ("something else is said here", 2, 1)
    assert got[3] == ("", 2, 2)  # a null id comes first
    assert (got[4], got[5], got[None][2], got[6][2], got[7][2]) == ((None, 0, 0), ("", 1, 0), 0, 0, 0)


def test_line_dedup_handles_odd_tables(odd, empty):
    got = line_templates.without_recurring_lines(odd)
    assert got.count() == odd.count() and set(odd.columns) <= set(got.columns)
    assert {r.n_chars == len(r.text or "") or r.text is None for r in got.collect()} == {True}
    assert line_templates.without_recurring_lines(empty).count() == 0


# Quality rules

def test_counts_against_brute_force(odd, small):
    for frame in (odd, small):
        got = rules.measured(frame).withColumn("bad", rules.base_failed()).collect()
        for r in got:
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.bad) == brute.quality_counts(r.text)


def test_binomial_tail_is_exact(spark):
    cases = [(0, 10), (1, 50), (3, 400), (20, 3000), (39, 4000), (70, 5000), (9000, 1_000_000)]
    frame = spark.createDataFrame([(float(k), float(n)) for k, n in cases], "k double, n double")
    got = [r[0] for r in frame.select(rules.binomial_tail(F.col("k"), F.col("n"), 0.02)).collect()]
    for (k, n), p in zip(cases, got):
        terms = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(0.02) + (n - i) * math.log(0.98)
                 for i in range(k + 1)]
        want = sum(map(math.exp, terms))
        assert p == 1 if k >= 0.02 * n else p == pytest.approx(want, rel=1e-6, abs=1e-250)


def test_accepted_rules_drop_few_good_documents(spark, odd, empty):
    rng = random.Random(3)
    rows = []
    for i in range(3000):
        bad = i % 3 == 0
        w = [f"w{rng.randrange(10**6)}" + ("###" if bad and rng.random() < 0.9 else "") for _ in range(80)]
        rows.append((i, " ".join(w), "en"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i % 3 != 0), 0) for i in range(3000)] + [(1, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    measures = rules.measured(docs)
    got = rules.judged(measures, rules.learned(measures, labels)).select("doc_id", "kept").collect()
    good = [r.kept for r in got if r.doc_id % 3]
    assert sum(good) >= 0.98 * len(good) and not any(r.kept for r in got if r.doc_id % 3 == 0)
    few = rules.learned(measures, labels.limit(20))
    assert all(r.kept for r in rules.judged(measures, few).collect())  # too few labels: no rule
    m = rules.measured(odd)
    assert rules.judged(m, rules.learned(m, labels)).count() == odd.count()
    m = rules.measured(empty)
    assert rules.judged(m, rules.learned(m, labels.limit(0))).count() == 0


def test_levels_against_a_plain_chain(spark):
    rng = random.Random(11)
    share = {"big": 0.002, "mid": 0.004, "loose": 0.2, "few": 0.0}
    size = {"big": 3000, "mid": 900, "loose": 900, "few": 100}
    rows = [(s, 100, 500, rng.choice([0, 0, 3, 15, 40, 90]) if rng.random() < 5 * share[s] else 0, 0, 10, 0) for s in size for _ in range(size[s])]
    rows += [("big", 10, 50, 99, 0, 1, 0)] * 500  # fails the base rules and counts for nothing
    frame = spark.createDataFrame(rows, "s string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_lines long, n_repeat_words long")
    got = {r.s: r.level for r in rules.accepted(frame, "s").collect()}
    want = {}
    for s, n in size.items():
        for level, cut in enumerate(rules.GRID["symbols_per_word"]):
            k = sum(r[0] == s and r[1] >= 50 and (r[3] / 100 > cut or -5.0 > rules.GRID["short_words"][level]) for r in rows)
            tail = sum(math.comb(n, i) * 0.02 ** i * 0.98 ** (n - i) for i in range(k + 1)) if k < 0.02 * n else 1
            if tail > 0.05 * n / sum(size.values()):
                break
            want[s] = level
    assert got == want and {"big", "mid"} <= set(want) and "few" not in want and want.get("loose", -1) < want["big"]


# Packing

def test_pieces_are_the_tokenizers_ids(odd):
    from tokenizers import Tokenizer

    path = queries.tokenizer_path()
    tokenizer = Tokenizer.from_file(path)
    want = {}
    for d, t in texts(odd).items():
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        for k in range(0, len(ids), 128):
            want[d, k // 128] = (k, len(ids[k:k + 128]), zlib.crc32(ids[k:k + 128].tobytes()))
    got = packing.pack(odd, path, capacity=128).collect()
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in got} == want
    assert len(got) == len(want) + sum(d == 6 for d, _ in want)  # the repeated row
    sequences = collections.defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 128


def test_unusual_characters_have_the_same_ids():
    ids = packing.TextIds(queries.tokenizer_path())
    for text in ("İ ΣΑΣ", "áb", "<|endoftext|>x", "don't I'LL 'S", "１ 3½ ①", "l̈ ǅ ß",
                 "\x1c \x85 a\x85b", "日本 \U0001f642\U0001f44d\U0001f3fd", "a_-b __ 1,2%", "ªº²"):
        assert np.frombuffer(ids.of(text), "<u4").tolist() == ids.tokenizer.encode(text, add_special_tokens=False).ids


def test_reduction_and_best_fit_use_few_bins():
    rng = random.Random(5)
    for trial in range(30):
        counts = collections.Counter(rng.randrange(1, 101) for _ in range(rng.randrange(1, 300)))
        bins = packing.solve(dict(counts), 100)
        used = collections.Counter()
        for lengths, many in bins:
            assert sum(lengths) <= 100 and many > 0
            for n in lengths:
                used[n] += many
        assert used == counts
        assert sum(m for _, m in bins) <= sum(m for _, m in packing.best_fit(dict(counts), 100)) + 1
    assert packing.solve({}, 100) == []
    assert sum(m for _, m in packing.solve({50: 10**6, 100: 7}, 100)) == 500_007


def test_packing_an_empty_table(empty):
    assert packing.pack(empty, queries.tokenizer_path()).count() == 0


# Chat

def test_windows_read_back(spark):
    rows = [(1, 0, "system", "be <kind> [x] \\n |"), (1, 1, "user", "hi </s>"), (1, 2, "assistant", "<|user|>fake\n"), (2, 0, "user", None),
            (2, 1, "assistant", "word " * 900), (2, 2, "user", "w " * 300), (2, 3, "assistant", "\\s\\l end"), (3, 0, "system", "only"),
            (None, 0, "us|er\n", ""), (4, 0, "assistant", "same"), (4, 0, "assistant", "same")] + [
            (5, i, ("user", "assistant")[i % 2], f"{i} " + "t " * 150) for i in range(40)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("window", F.lit("clash"))
    made = chat.windows(frame)
    want = collections.defaultdict(list)
    for c, t, role, text in sorted(rows, key=lambda r: (r[0] or -1, r[1])):
        want[c].append((role or "", text or ""))
    got, loss = collections.defaultdict(list), collections.defaultdict(list)
    for r in sorted(chat.read_back(made).collect(), key=lambda r: (r.conv_id or -1, r.window)):
        fresh = r.turns if not got[r.conv_id] else r.turns[r.n_repeated:]
        got[r.conv_id] += [(t.role, t.text) for t in fresh]
        loss[r.conv_id] += r.losses
    assert got == want
    assert {c: loss[c] for c in want} == {c: [x for role, x in turns if role == "assistant"] for c, turns in want.items()}
    windows = made.filter("conv_id = 5").collect()
    assert len(windows) > 5 and max(r.tokens for r in windows) <= chat.BUDGET and any(r.n_repeated for r in windows)
    assert chat.windows(frame.limit(0)).count() == 0


def greedy(tokens, budget, history):
    """Plain form of the spans: (first own turn, past, first repeated turn) of turns without a system turn."""
    spans, start = [], 0
    while start < len(tokens):
        room, past = budget - (history if start else 0), start + 1
        while past < len(tokens) and sum(tokens[start:past + 1]) <= room:
            past += 1
        left, back = min(history, budget - sum(tokens[start:past])), start
        while back and sum(tokens[back - 1:start]) <= left:
            back -= 1
        spans.append((start, past, back))
        start = past
    return spans


def test_windows_are_greedy_and_within_the_budget(spark):
    rng = random.Random(8)
    sizes = {1: [40] * 20 + [950] + [40] * 20, 2: [rng.randrange(1, 400) for _ in range(300)], 3: [1500, 3, 1500], 4: [700, 300, 12, 1020]}
    rows = [(c, i, "user", " ".join(["w"] * n)) for c, ns in sizes.items() for i, n in enumerate(ns)]
    rows += [(5, i, "system" if not i else "user", "w " * 200) for i in range(30)]
    made = chat.windows(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    got = collections.defaultdict(list)
    for r in sorted(made.collect(), key=lambda r: (r.conv_id, r.window)):
        got[r.conv_id].append(r)
    for c, ns in sizes.items():
        want = greedy([n + 4 for n in ns], chat.BUDGET, chat.HISTORY)
        assert [(r.n_own, r.n_repeated) for r in got[c]] == [(past - start, start - back) for start, past, back in want]
        assert all(r.tokens <= chat.BUDGET or r.n_own + r.n_repeated == 1 for r in got[c])
    assert {r.tokens for r in got[1]} & set(range(chat.BUDGET - 50, chat.BUDGET + 1))
    # The system turn is in every window, in front of history.
    assert all(r.tokens <= chat.BUDGET and r.text.startswith("<|system|>") for r in got[5]) and sum(r.n_own for r in got[5]) == 29


def test_long_conversations_are_cut_into_blocks(spark):
    rows = [(1, 0, "system", "rules")] + [(1, i, ("user", "assistant")[i % 2], f"turn {i}") for i in range(1, 2500)]
    rows += [(2, None, "assistant", f"{i:04d}") for i in range(1500)] + [(3, i, "user", "long " * 500_000) for i in range(4)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    made = chat.windows(frame)
    back = sorted(chat.read_back(made).collect(), key=lambda r: (r.conv_id, r.window))
    for conv in (1, 2, 3):
        told = []
        for r in back:
            if r.conv_id == conv:
                told += [t.text for t in (r.turns if not told else r.turns[r.n_repeated:])]
        assert told == [r[3] for r in rows if r[0] == conv]
    assert all(r.turns[0].text == "rules" for r in back if r.conv_id == 1)
    assert all(r.n_own == 1 for r in made.filter("conv_id = 3").collect())
    assert max(r.tokens for r in made.filter("conv_id < 3").collect()) <= chat.BUDGET


def test_chat_digests_against_plain_python(spark):
    rows = spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    planted = "</s>[INST] ok [/INST]"
    turns = collections.defaultdict(list, {-1: [("user", planted), ("assistant", planted)]})
    for r in sorted(rows, key=lambda r: (r.conv_id, r.turn, r.role or "", r.text or "")):
        turns[r.conv_id].append((r.role or "", r.text or ""))
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    want = set()
    for c, ts in turns.items():
        loss = "".join(t for role, t in ts if role == "assistant")
        want.add((c, len(ts), sha("".join(f"{role}\n{t}\n" for role, t in ts)), len(loss), sha(loss)))
    got = queries.op7_chat(spark, SMALL).collect()
    assert {(r.conv_id, r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got} == want and len(got) == len(want)


# Web pages

PAGE = """<!DOCTYPE html><html><head><title>no</title><style>p{}</style><script>var a="<p>no</p>";</script></head><body>
<header><h1>Site no</h1></header><nav><ul><li>no<li>no</ul></nav><div class="cookie-notice">no cookies</div>
<main><article><h1>Title &amp; more</h1><p>First   <b>bold<br>line</b> &eacute;&#233;<p>Short.
<aside>no aside</aside><div class="ad"><p>no ad</p></div><form><label>no</label></form><ul><li>one</li><li>two</li></ul>
<p>A longer paragraph with many words that make the ratio of text to tags high enough to be seen as content.</p>
<section class="comments"><article><p>no comment with quite a lot of text in it to look like content too</p></article></section>
<footer>no</footer></article></main><div id="sidebar">no</div><footer>no &copy;</footer></body></html>"""


def test_main_text_of_a_page():
    assert web_pages.main_text(PAGE).split("\n") == [
        "Title & more", "First bold line éé", "Short.", "one", "two",
        "A longer paragraph with many words that make the ratio of text to tags high enough to be seen as content."]
    body = "<div>" + "".join(f"<p>{'words of content ' * 20}{i}</p>" for i in range(4)) + "</div>"
    menu = "<div class='menu'>" + "<a href=x>l</a>" * 9 + "</div>"
    assert len(web_pages.main_text(f"<body>{menu}{body}</body>").split("\n")) == 4


@pytest.mark.parametrize("html", [None, "", "   ", "<", "<!", "<![CDATA[x", "<p", "</p>", "<script>never closed", "<!-- never closed", "&#xZZ;&bogus;"])
def test_broken_pages_do_not_fail(html):
    assert isinstance(web_pages.main_text(html), str)


def test_every_page_has_a_row(spark):
    rows = [(1, "u", PAGE), (1, "u", PAGE), (None, None, None), (2, "v", "")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    got = web_pages.extracted(frame).collect()
    assert sorted((r.page_id or 0, r.n_chars) for r in got) == [(0, 0), (1, len(web_pages.main_text(PAGE))), (1, len(web_pages.main_text(PAGE))), (2, 0)]


# Language model

def test_base_scores_and_model(small, odd, empty):
    for frame in (small, odd.filter("doc_id is null or doc_id <> 6")):
        docs = texts(frame)
        want, got = brute.unigrams(docs), maxent.scored(frame, rounds=1, frequent=50).collect()
        assert len(got) == len(docs)
        for r in got:
            held, tokens, known, total, base = want[r.doc_id]
            assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, tokens, known, total)
            assert r.base_score == pytest.approx(base, rel=1e-9) and r.score < 0
    assert maxent.scored(empty, rounds=1).count() == 0


def test_expected_counts_against_each_token():
    rng = np.random.default_rng(9)
    token = rng.integers(0, 60, 5000).astype(np.uint64)
    of = maxent.features(token, np.array([0, 1200, 1200, 5000]))
    weights, bias = rng.normal(size=(maxent.KINDS * maxent.BUCKETS, maxent.CLASSES)), rng.normal(size=maxent.CLASSES)
    distinct, n = maxent.contexts(of)
    assert n.sum() == 5000 and len(n) < 5000
    rows = {tuple(c): k for c, k in zip(distinct.T.tolist(), n.tolist())}
    assert rows == dict(collections.Counter(map(tuple, of.T.tolist())))
    want = np.zeros_like(weights)
    for f in of.T:
        p = np.exp(weights[f].sum(axis=0) + bias)
        want[f] += p / p.sum()
    got = np.zeros_like(weights)
    for f, k in zip(distinct.T, n):
        p = np.exp(maxent._logits(weights, bias, f[:, None])[0])
        got[f] += k * p / p.sum()
    assert np.allclose(got, want)


def test_model_beats_unigrams_where_context_tells(spark):
    rng = random.Random(11)
    rows = [(i, " ".join(f"{'ab'[i % 2]}{rng.randrange(40)}{'xy'[i % 2] * 3}" for _ in range(120))) for i in range(300)]
    got = maxent.scored(spark.createDataFrame(rows, "doc_id long, text string"), rounds=2).filter("held_out").collect()
    assert sum(r.score for r in got) > sum(r.base_score for r in got)


def some_tree(rng, frequent=300, others=4000):
    """A tree, its words, their counts, which of them are frequent, and their leaves."""
    word, n = rng.integers(0, 1 << 63, others, dtype=np.uint64), rng.integers(1, 9, others)
    word &= ~np.uint64(24)  # classes 0 to 7 only
    n[:frequent] *= 50
    mass = np.zeros(maxent.CLASSES * maxent.GROUPS, np.int64)
    np.add.at(mass, maxent.groups(word[frequent:]), n[frequent:] + 1)
    return maxent.Tree(word[:frequent], n[:frequent], mass), word, n, mass


def test_words_of_a_class_sum_to_one_in_every_context():
    rng = np.random.default_rng(3)
    tree, word, n, mass = some_tree(rng)
    assert tree.find(word).tolist() == [int(np.searchsorted(tree.word, w)) if i < 300 else -1 for i, w in enumerate(word)]
    kind = (tree.word & np.uint64(maxent.CLASSES - 1)).astype(int)
    of_class = np.concatenate((kind, np.repeat(np.arange(maxent.CLASSES), maxent.GROUPS), np.arange(maxent.CLASSES)))
    leaves = np.flatnonzero(np.concatenate((np.ones(300, bool), mass > 0, np.ones(maxent.CLASSES, bool))))
    none, seen = np.zeros((maxent.KINDS, maxent.CLASSES, 1 << maxent.CELL_BITS), np.float32), set()
    for weights in (none, rng.normal(size=none.shape).astype(np.float32)):
        for context in rng.integers(0, 1 << 63, (4, maxent.KINDS), dtype=np.uint64):
            p = np.exp(maxent._within(tree, weights, leaves, tuple(np.full(len(leaves), c) for c in context)))
            assert np.allclose(np.bincount(of_class[leaves], weights=p, minlength=maxent.CLASSES), 1, atol=1e-5)
            seen.add(p[0])
            if weights is none:  # add-one counts
                own = np.bincount((word & np.uint64(maxent.CLASSES - 1)).astype(int), weights=n + 1, minlength=maxent.CLASSES) + 1
                count = dict(zip(word.tolist(), n.tolist()))
                assert np.allclose(p[:300], [(count[int(w)] + 1) / own[k] for w, k in zip(tree.word, kind)], rtol=1e-4)
    assert len(seen) == 5


def test_what_splits_miss_against_each_token():
    rng = np.random.default_rng(4)
    tree, word, _, _ = some_tree(rng)
    token = word[rng.integers(0, len(word), 900)]
    context = maxent.before(token, np.array([0, 400, 400, 900]))
    weights = rng.normal(size=(maxent.KINDS, maxent.CLASSES, 1 << maxent.CELL_BITS)).astype(np.float32)
    for given in (None, weights):
        want, got = np.zeros((2, *weights.shape)), np.zeros((1 if given is not None else 2, *weights.shape))
        for i, leaf in enumerate(tree.known(token)):
            k = int(token[i]) % maxent.CLASSES
            for at in range(tree.begin[leaf], tree.begin[leaf] + tree.size[leaf]):
                key, bias = int(tree.path[at]) & 0xFFFFFFFF, (tree.path[at:at + 1] >> np.uint64(32)).astype(np.uint32).view(np.float32)[0]
                cells = [((int(c[i]) >> 32 ^ key & ~1) * 0x9E3779B1 & 0xFFFFFFFF) >> (32 - maxent.CELL_BITS) for c in context]
                z = float(bias) + (sum(float(given[j, k, c]) for j, c in enumerate(cells)) if given is not None else 0)
                p = 1 / (1 + math.exp(-z))
                for j, c in enumerate(cells):
                    want[0, j, k, c] += (key & 1) - p
                    want[1, j, k, c] += p * (1 - p)
        maxent._missed(tree, given, token, context, got)
        assert np.allclose(got, want[:len(got)], atol=1e-4)


def test_context_tells_words_of_a_class_apart(spark):
    rng = random.Random(12)
    # All words end alike, so that they are of one class; each is followed by its own one.
    rows = [(i, " ".join(f"open{k}same shut{k}same" for k in (rng.randrange(30) for _ in range(60)))) for i in range(300)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    for frequent in (1000, 5):  # also words beyond the frequent ones
        got = maxent.scored(frame, rounds=2, frequent=frequent).filter("held_out").collect()
        tokens = sum(r.n_tokens for r in got)
        assert sum(r.score - r.base_score for r in got) / tokens > 0.2


def test_counts_of_words_do_not_depend_on_where_they_are_held(small):
    want = {r.doc_id: r.score for r in maxent.scored(small, rounds=0, frequent=1 << 17).collect()}
    got = {r.doc_id: r.score for r in maxent.scored(small, rounds=0, frequent=5).collect()}
    assert got == pytest.approx(want, rel=1e-4)


# Decontamination

def test_leaks_with_other_parameters(spark, empty):
    item = "Train number 12 leaves the old town of Arlen at 9 km per hour and Marek follows with 20 crates of fruit"
    other = "Train number 31 leaves the old town of Bexley at 7 km per hour and Tamsin follows with 44 crates of fruit"
    mixed = "number 5 is what number 5 needs when number 5 stands beside number 8 in the long row"
    rows = [(1, f"before it {item} after it"), (2, f"before {other} after"), (3, "nothing like the item is in this text at all, none of it"), (4, None), (5, ""),
            (6, mixed.replace("number 5 needs", "number 6 needs")), (7, mixed.replace("5", "9")), (1, f"before it {item} after it"), (None, item)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"hash": F.lit(1), "item_id": F.lit("clash")})
    items = [(10, item), (11, mixed), (12, None), (13, ""), (14, "too short"), (10, item)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    for block in (decontaminate.BLOCK, 3):
        got = {(r.doc_id, r.item_id): r.literal for r in decontaminate.leaks(docs, benchmark, block=block).collect()}
        assert got == {(1, 10): True, (2, 10): False, (7, 11): False, (None, 10): True}
    kept = decontaminate.without_leaks(docs, benchmark)
    assert kept.columns == docs.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [3, 4, 5, 6]  # a leak without an id goes too
    assert decontaminate.leaks(empty, benchmark).count() == 0
    assert decontaminate.leaks(docs, benchmark.limit(0)).count() == 0
