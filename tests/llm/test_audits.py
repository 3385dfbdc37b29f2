"""Phrase index, source divergence and Merkle manifest against brute force on odd tables."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from touchpath.llm import divergence, merkle, phrase_index
from touchpath.llm.common import byte_table, words_in

DOCS = "doc_id long, text string, lang string, source string, n_chars long, shard string, term string, n long, key string, pos long"
ITEMS = "item_id long, text string, term string, shard long"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"


def low(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


def rows(df):
    return [r.asDict(True) for r in df.collect()]


RNG = random.Random(3)
VOCABULARY = ["an", "Be", "co", "DU", "él", "ÀÉ", "x1", "9", "日本"] + [f"w{i}" for i in range(30)]


def prose(n):
    return " ".join(RNG.choice(VOCABULARY) for _ in range(n))


PASSAGE = prose(25)


@pytest.fixture(scope="module")
def docs(spark):
    texts = [None, "", " \t\n", "one", "one,two;three", "\x00nul\x00 é\x85e", "a" * 5000, "ab " * 3000]
    texts += [prose(RNG.randint(5, 60)) for _ in range(40)] + [prose(2000)]
    texts += [f"{prose(4)} {PASSAGE.upper()} {prose(5)}", PASSAGE, f"{PASSAGE}. {PASSAGE}", "it is a rare-needle, here", "rare", "needle"]
    made = [(i, t, ["en", "de", None][i % 3], ["a", None, "b", "é", ""][i % 5 if i % 7 else 0], len(t or ""), "s", "t", 1, "k", 2)
            for i, t in enumerate(texts)]
    made += [made[20], made[20], (None, PASSAGE, "en", "a", *[None] * 6), (None,) * 10, (-5, "Lone", "fr", "only", 4, "", "", 0, "", 0)]
    return spark.createDataFrame(made, DOCS).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def items(spark):
    made = [(3, PASSAGE), (3, "rare needle"), (20, PASSAGE + " unseen"), (100, "Rare  NEEDLE"), (4, None), (5, ""), (6, " - "), (7, "ab ab"),
            (8, "ab " * 12), (None, "ONE"), (9, "nowhere to be found"), (3, PASSAGE)]
    return spark.createDataFrame([(i, t, "x", 1) for i, t in made], ITEMS)


def test_words_come_in_bounded_lists():
    text = ("Ab1 cé_d " * 50).encode()
    for piece in (1, 7, 10**6):
        lists = list(words_in(text, byte_table("0123456789"), piece))
        assert [w for x in lists for w in x] == ["ab1".encode(), "cé".encode(), b"d"] * 50
        assert piece > 7 or max(map(len, lists)) <= 3
    assert list(words_in(None, byte_table())) == []


def brute_hits(text, windows):
    words = re.findall(WORD, low(text))
    hit, found = set(), set()
    for item, phrase in windows:
        for i in range(len(words) - len(phrase) + 1):
            if tuple(words[i:i + len(phrase)]) == phrase:
                hit.update(range(i, i + len(phrase)))
                found.add(item)
    return len(words), len(hit), sorted(found, key=lambda x: x.encode())


@pytest.mark.parametrize("shard_bytes", [1, 5000, phrase_index.SHARD_BYTES])
def test_phrases(docs, items, shard_bytes):
    windows = set()
    for r in rows(items):
        w = re.findall(WORD, low(r["text"]))
        name = "" if r["item_id"] is None else str(r["item_id"])
        windows |= {(name, tuple(w[i:i + 10])) for i in range(max(1, len(w) - 9)) if w}
    want = []
    for r in rows(docs):
        n, hit, found = brute_hits(r["text"], windows)
        want.append((r["doc_id"], n, hit, len(found), hashlib.sha256(",".join(found).encode()).hexdigest(), hit > 0))
    got = [tuple(r.values()) for r in rows(phrase_index.decontaminated(docs, items, shard_bytes=shard_bytes))]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert {x[3] for x in want} >= {0, 1, 2}


def test_spans_are_where_the_words_are(docs, items):
    index = phrase_index.build_index(docs, 5000)
    texts = {r["doc_id"]: re.findall(WORD, low(r["text"])) for r in rows(docs)}
    whole = re.findall(WORD, low(PASSAGE))
    spans = [(r["doc_id"], s) for r in rows(phrase_index.exact_matches(index, items)) for s in r["spans"]]
    assert len(spans) > 10
    for doc_id, s in spans:
        if s["item"] == "20" and doc_id is not None:
            part = texts[doc_id][s["start"]:s["stop"]]  # upper-cased copies keep other letters than A-Z
            assert len(part) >= 10 and any(whole[i:i + len(part)] == part for i in range(len(whole)))
        if s["item"] == "100":
            assert texts[doc_id][s["start"]:s["stop"]] == ["rare", "needle"]


def test_phrases_of_nothing(docs, none, items):
    assert rows(phrase_index.decontaminated(none, items)) == []
    clean = rows(phrase_index.decontaminated(docs, items.limit(0)))
    assert len(clean) == docs.count() and not any(r["contaminated"] for r in clean)


def test_near_places_are_the_shortest_runs():
    rng = random.Random(1)
    for _ in range(200):
        text = [rng.choice("abcde") for _ in range(40)]
        terms = [t for t in "abc" if t in text]
        lists = {t: np.array([i for i, x in enumerate(text) if x == t]) for t in set(text)}
        starts, stops = phrase_index.near_places(terms, 6, lists)
        runs = [(i, j) for i in range(40) for j in range(i + 1, min(i + 6, 40) + 1) if set(terms) <= set(text[i:j])]
        best = {(i, j) for i, j in runs if not any((i, j) != (a, b) and i <= a and b <= j for a, b in runs)}
        assert best <= set(zip(starts.tolist(), stops.tolist())) <= set(runs)


def test_proximity(spark):
    texts = ["alpha of the beta", "beta x alpha", "alpha " + "x " * 40 + "beta", "alpha", "beta", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    items = spark.createDataFrame([(1, "Alpha beta"), (2, "alpha unseen")], "item_id long, text string")
    found = rows(phrase_index.near_matches(phrase_index.build_index(docs), items, within=5))
    assert {r["doc_id"]: [tuple(s.values()) for s in r["spans"]] for r in found} == {
        0: [("1", 0, 4)], 1: [("1", 0, 3)], 2: [], 3: [], 4: [], 5: []}


def brute_divergences(table, least, top):
    docs = [(r["lang"] or "", r["source"] or "", Counter(re.findall(TERM, low(r["text"])))) for r in table]
    out = []
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        often = Counter(t for _, _, c in mine for t in c)
        kept = sorted(t for t, n in often.items() if n >= least)
        sources = sorted({s for _, s, _ in mine})
        counts = {s: Counter() for s in sources}
        for _, s, c in mine:
            counts[s].update(c)

        def shares(c):
            total = sum(c[t] for t in kept) + 5 * len(kept)
            return {t: 1 + 10**9 * (c[t] + 5) // total for t in kept}

        p, q = {s: shares(counts[s]) for s in sources}, shares(sum(counts.values(), Counter()))
        for s in sources:
            pairs = [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in sources if o != s]
            terms = [(t, p[s][t] - q[t]) for t in kept if counts[s][t] and p[s][t] > q[t]]
            for part, found, many in (("pair", pairs, None), ("term", terms, top)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, i + 1) for i, (item, value) in enumerate(found[:many])]
    return out


@pytest.mark.parametrize("limits", [{}, {"max_terms": 5, "bucket": 3, "pairs": 2}])
@pytest.mark.parametrize("least", [1, 3, 1000])
def test_divergences(docs, limits, least):
    got = [tuple(r.values()) for r in rows(divergence.divergences(docs, least, 4, **limits))]
    want = brute_divergences(rows(docs), least, 4)
    assert sorted(got) == sorted(want)
    assert any(x[2] == "pair" for x in want) and (least == 1000 or any(x[2] == "term" for x in want))


def test_divergences_of_nothing(none):
    assert rows(divergence.divergences(none)) == []


def test_shares_are_exact_beyond_64_bits():
    counts, total = [0, 7, 10**12, 3 * 10**17], 4 * 10**17
    got = divergence.shares(np.array(counts), total).tolist()
    assert got == [1 + 10**9 * (c + 5) // total for c in counts]


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def climb(nodes):
    """The root of a list of digests, and each one's steps (left, right)."""
    steps, places = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i:i + 16] for i in range(0, len(nodes), 16)]
        for leaf, at in enumerate(places):
            run = runs[at // 16]
            steps[leaf].append(("".join(run[:at % 16]), "".join(run[at % 16 + 1:])))
        nodes, places = [h(*run) for run in runs], [at // 16 for at in places]
    return nodes[0], steps


def brute_manifest(table):
    def leaf(r, text):
        values = [r["doc_id"], r["source"], r["lang"], r["n_chars"], text]
        return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])

    sources, found = {}, []
    for r in table:
        change = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 and r["text"] is not None
        sources.setdefault(r["source"], []).append((r, leaf(r, r["text"]), leaf(r, low(r["text"]) if change else r["text"])))
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    for name in names:
        sources[name].sort(key=lambda x: (x[0]["doc_id"] is not None, x[0]["doc_id"], x[1], x[2]))
    climbed = [climb([x[1] for x in sources[name]]) for name in names]
    root, above = climb([subroot for subroot, _ in climbed])
    for name, (subroot, steps), top in zip(names, climbed, above):
        for (r, own, other), path in zip(sources[name], steps):
            at = other
            for left, right in path + top:
                at = h(left, at, right)
            proof = h(*[part for step in path + top for part in step])
            found.append((r["doc_id"], own, subroot, root, proof, at, at == root))
    return found


def manifest(df):
    return sorted((tuple(r.values()) for r in rows(merkle.manifest(df))), key=repr)


def test_manifest(spark, docs, none):
    want = brute_manifest(rows(docs))
    assert manifest(docs) == sorted(want, key=repr)
    assert {x[-1] for x in want} == {True, False}
    assert manifest(none) == []


def test_manifest_of_many_levels(spark):
    made = [(i, "Text" if i % 3 else None, "en", "hot" if i % 3 else f"s{i % 19}", i) for i in range(900)]
    made += [(i, "x", None, f"many{i}", None) for i in range(1000, 1300)]
    df = spark.createDataFrame(made, "doc_id long, text string, lang string, source string, n_chars long").repartition(7)
    assert manifest(df) == sorted(brute_manifest(rows(df)), key=repr)


@pytest.mark.parametrize("many", [1, 2, 16, 17, 256, 257])
def test_manifest_of_one_source(spark, many):
    df = spark.createDataFrame([(i, "T", "en", None, 1) for i in range(many)], "doc_id int, text string, lang string, source string, n_chars int")
    assert manifest(df) == sorted(brute_manifest(rows(df)), key=repr)
