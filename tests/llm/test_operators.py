"""Operators against brute force on small tables that hold every odd case."""

import hashlib
import json
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from touchpath.llm import (mixing, packing, pii, quality_rules, simhash, suffix_dedup, suffix_tree,
                           token_counts, vector_graph, warc)
from touchpath.llm.common import components
from touchpath.llm.packing import tokenizer_path

DOCS = "doc_id long, text string, lang string, source string, n_chars long, row string, q string, taken long"
LABELS = "doc_id long, quality int, toxic int"


def texts():
    rng = random.Random(5)
    words = ["".join(rng.choice(["an", "be", "co", "du", "él"]) for _ in range(rng.randint(1, 3))) for _ in range(80)]
    line = lambda n: " ".join(rng.choice(words) for _ in range(n)) + ". "
    shared = line(90)
    out = [None, "", " \n\t ", "one", "one two", "\x1c odd \x85 space s", "a<|endoftext|>b <|startoftext|>"]
    out += [line(120)] * 3 + [shared + line(30), line(40) + shared, line(20) + shared + shared]
    out += [line(12) + "\n" + line(12) + "\n\n" + line(8) for _ in range(12)] + ["x" * 3000, "ab " * 4000, line(9000)]
    out += ["Mail a.b@site.org or A.B@site.org, 10.1.2.3, +1 (217) 555-0134, 4111 1111 1111 1111; Mrs Weber, Mr Weber"]
    return out


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, ["en", None][i % 2], ["b", "a", None][i % 3], None, "r", "q", 1) for i, t in enumerate(texts())]
    rows += [rows[8], (None, "no id here", "en", "a", 1, None, None, None)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(7, 1, 0), (8, None, 0), (9, 0, 0), (7, 0, 0), (None, 1, 0), (10**6, 1, 0)], LABELS)


def rows(df):
    return [r.asDict() for r in df.collect()]


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_components(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (9, 8), (5, 5), (None, 4), (3, 1), (7, 8)], "a long, b long")
    assert {(r["node"], r["component"]) for r in rows(components(edges))} == {(1, 1), (2, 1), (3, 1), (7, 7), (8, 7), (9, 7)}


def test_quality_base(docs, labels):
    got = sorted((tuple(r.values()) for r in rows(quality_rules.quality_report(docs, labels))), key=repr)
    want = []
    for d in docs.select("doc_id", "text").collect():
        text, w = d.text or "", words_of(d.text)
        grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
        often = Counter(grams)
        covered = {i + k for i, g in enumerate(grams) if often[g] > 1 for k in range(3)}
        lines = [x for x in text.split("\n") if words_of(x)]
        failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
        want.append((d.doc_id, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)),
                     len(lines) - len(set(lines)), len(covered), failed, not failed))
    assert got == sorted(want, key=repr)  # too few labels prove no cutoff, so the base decides


def test_binomial_tail(spark):
    cases = [(1, 0, 0.5), (100, 3, 0.1), (2000, 0, 0.004), (5000, 11, 0.004), (10, 9, 0.3)]
    for n, k, p in cases:
        got = spark.range(1).select(quality_rules.binomial_tail(F.lit(n), F.lit(k), p).alias("x")).first().x
        exact = sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1)) if k < n * p else 1.0
        assert got == pytest.approx(exact, rel=1e-8)


def test_thresholds_reject_only_what_is_proven(spark):
    feature = "doc_id long, stratum string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long, base_failed boolean"
    made = [(i, "en", 100, 500, 60 if i < 3 else 1, 0, 0, 5, False) for i in range(6000)]
    made += [(i, "xx", 100, 500, 0, 0, 0, 5, False) for i in range(6000, 6020)]
    features = spark.createDataFrame(made, feature)
    good = spark.createDataFrame([(i, 1, 0) for i in range(6020)], LABELS)
    cuts = {r["stratum"]: r for r in rows(quality_rules.thresholds(features, good))}
    assert set(cuts) == {"en"} and cuts["en"]["cut_symbols"] == 0.1
    assert all(cuts["en"][f"cut_{r}"] is not None for r in quality_rules.RULES)


def test_small_strata_get_their_own_or_the_pooled_cutoffs(spark):
    feature = "doc_id long, stratum string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long, base_failed boolean"
    sizes = {"en": 2000, "es": 307, "xx": 20, "yy": 0, "zz": 400}
    made, good, at = [], [], 0
    for lang, n in sizes.items():
        for i in range(n + 1):  # the last one is bad and unlabelled
            bad = i == n or lang == "zz" and i % 2
            made.append((at, lang, 100, 500, 40 if i == n else 200 if bad else 1, 0, 0, 5, False))
            good += [(at, 1, 0)] * (i < n)
            at += 1
    features = spark.createDataFrame(made, feature)
    cuts = quality_rules.cutoffs_for(features, spark.createDataFrame(good, LABELS))
    assert {r["stratum"]: (r["proven_on"], r["cut_symbols"]) for r in rows(cuts)} == {
        "en": ("stratum", 0.1), "es": ("stratum", 0.1), "xx": (None, None), "yy": (None, None), "zz": (None, None)}
    calm = features.where("stratum <> 'zz'")
    cuts = quality_rules.cutoffs_for(calm, spark.createDataFrame(good, LABELS))
    assert {r["stratum"]: r["proven_on"] for r in rows(cuts)} == {"en": "stratum", "es": "stratum", "xx": "all strata", "yy": "all strata"}
    judged = rows(quality_rules.with_verdict(calm, cuts, F.col("doc_id")))
    assert [r["n_symbols"] for r in judged if not r["kept"]] == [40] * 4


def plain_fingerprint(text):
    w = (text or "").encode().lower().split()
    grams = [b" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("max_list", [64, 1])
def test_simhash(docs, max_list):
    got = rows(simhash.near_duplicates(docs, max_list))
    prints = [(d.doc_id, plain_fingerprint(d.text)) for d in docs.select("doc_id", "text").collect()]
    group = list(range(len(prints)))
    for _ in prints:
        for i, (_, a) in enumerate(prints):
            for j, (_, b) in enumerate(prints):
                if (a ^ b).bit_count() <= 2:
                    group[i] = group[j] = min(group[i], group[j])
    want = []
    for i, (k, p) in enumerate(prints):
        ids = [prints[j][0] for j in range(len(prints)) if group[j] == group[i] and prints[j][0] is not None]
        want.append((k, f"{p:016x}", min(ids, default=None)))
    assert sorted((tuple(r.values()) for r in got), key=repr) == sorted(want, key=repr)


def test_simhash_links_of_crowded_lists(spark):
    rng = random.Random(1)
    values = {rng.getrandbits(63)}
    while len(values) < 150:
        values.add(rng.choice(sorted(values)) ^ 1 << rng.randrange(12) ^ 1 << rng.randrange(12))
    df = spark.createDataFrame([(v,) for v in values], "fp long")
    for size in (4, 1000):
        got = {(r["node"], r["component"]) for r in rows(components(simhash.links(df, size)))}
        assert len(got) == len(values) and len({c for _, c in got}) == 1


def test_keep_one(docs):
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in rows(kept)]
    assert len(ids) == len(set(ids)) and {7, None} <= set(ids) and not {8, 9} & set(ids)


def test_keep_one_keeps_unrelated_texts_that_share_an_id_or_have_none(spark):
    texts = ["the quick brown fox jumps over it", "a wholly different sentence stands here", "third text of other words again"]
    made = [(i, t, "en", "a", 1, None, None, None) for i in (None, 7) for t in texts]
    made += [(None, texts[0] + " " + str(i) * 9, "en", "a", 1, None, None, None) for i in range(3)]
    kept = rows(simhash.keep_one(spark.createDataFrame(made, DOCS)))
    assert {r["text"] for r in kept} >= set(texts) and len({r["text"] for r in kept}) == 6
    assert sorted((r["doc_id"], r["text"]) for r in kept if r["doc_id"]) == sorted((7, t) for t in texts)


def test_pii(docs, nothing):
    got = {r["doc_id"]: r for r in rows(pii.surrogate_report(docs, "key"))}
    before = {d.doc_id: d.text for d in docs.select("doc_id", "text").collect()}
    changed = [k for k in before if got[k]["text"] != before[k]]
    assert len(changed) == 1 and got[changed[0]]["n_entities"] == 7
    text = got[changed[0]]["text"]
    for gone in ("a.b@site.org", "A.B@site.org", "10.1.2.3", "555-0134", "4111 1111 1111 1111", "Weber"):
        assert gone not in text
    small, big = re.findall(r"\S+@\S+\.org", text.replace(",", " "))
    assert small.upper().split("@")[0] == big.split("@")[0].upper()
    card = re.search(r"4\d{3} \d{4} \d{4} \d{4}", text).group().replace(" ", "")
    assert sum(int(c) if i % 2 else sum(map(int, str(2 * int(c)))) for i, c in enumerate(card)) % 10 == 0
    assert re.search(r"\+1 \(\d{3}\) \d{3}-\d{4}", text) and re.search(r"Mrs [A-Z][a-z]+, Mr [A-Z][a-z]+", text)
    assert rows(pii.surrogate_report(nothing, "key")) == []


def test_pii_replacements_are_distinct(spark):
    many = spark.createDataFrame([("ssn", f"{i:09d}") for i in range(0, 3000)] + [("name", f"male:n{i} s{i}") for i in range(300)], "kind string, canon string")
    made = rows(pii.replacements(many, "k"))
    assert len(made) == 3300 and len({(r["kind"], r["made"]) for r in made}) == 3300
    assert not {r["made"] for r in made} & {r["canon"] for r in made}


def test_pii_names_keep_their_surrogate_without_or_with_another_title(spark):
    text = "Weber came. Mrs Weber met Dr Weber; Weber's hat, WEBER, Weberin. Mr Hans Vogel left, Vogel or Hans stays."
    df = spark.createDataFrame([(1, text, "en", "a", 1, None, None, None), (2, "Weber alone", "en", "a", 1, None, None, None)], DOCS)
    got = {r["doc_id"]: r for r in rows(pii.surrogate_report(df, "key"))}
    new = re.search(r"Mrs (\w+) met", got[1]["text"]).group(1)
    first, last = re.search(r"Mr (\w+) (\w+) left", got[1]["text"]).groups()
    assert got[1]["text"] == f"{new} came. Mrs {new} met Dr {new}; {new}'s hat, {new.upper()}, Weberin. Mr {first} {last} left, {last} or {first} stays."
    assert got[1]["n_entities"] == 8 and got[2] == {"doc_id": 2, "n_entities": 0, "text": "Weber alone"}


def test_pii_names_never_run_out(spark, monkeypatch):
    monkeypatch.setitem(pii.SYLLABLES, "latin", "ba be")
    monkeypatch.setitem(pii.ENDINGS, ("latin", "either"), "ley")
    many = spark.createDataFrame([("name", f"either:n{i}") for i in range(12)], "kind string, canon string")
    made = rows(pii.replacements(many, "k"))
    assert len(made) == 12 and len({r["made"] for r in made}) == 12


def test_mix(docs, nothing):
    got = rows(mixing.mix_report(docs, 1))
    assert got == rows(mixing.mix_report(docs, 1)) and len(got) == docs.count()
    assert all(r["taken"] <= 2 * r["size"] for r in got)
    by = {}
    for r in rows(mixing.mix(docs, 1)):
        t = by.setdefault(r["source"], [r["target"], 0, r["source_size"]])
        t[1] += r["taken"]
    assert all(abs(t[0] - t[1]) <= 100 and t[0] <= 2 * t[2] for t in by.values())
    assert sum(t[0] for t in by.values()) == pytest.approx(1.5 * sum(t[2] for t in by.values()))
    assert rows(mixing.mix_report(nothing)) == []
    mixed = rows(mixing.mixed_texts(docs, 1))
    taken = Counter()
    for r in got:
        taken[r["doc_id"]] += r["taken"]
    assert {r["doc_id"]: len(words_of(r["text"])) for r in mixed} == {k: v for k, v in taken.items() if v}


def test_sainte_lague(spark):
    rng = random.Random(2)
    for seats in (0, 1, 5, 40, 1000):
        votes = [rng.randint(0, 1000) for _ in range(9)]
        df = spark.createDataFrame([(0, i, float(v), seats) for i, v in enumerate(votes)], "g int, p int, v double, s long")
        won = {r["p"]: r["won"] for r in rows(mixing.sainte_lague(df, ["g"], ["p"], "v", "s"))}
        want = Counter(i for _, i in sorted(((-v / (2 * k + 1), i) for i, v in enumerate(votes) for k in range(seats) if v))[:seats])
        assert won == {i: want[i] for i in range(9)}


def test_packing(docs, nothing):
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(tokenizer_path(packing.TOKENIZER))
    got = rows(packing.packed(docs))
    left = {}
    for d in docs.select("doc_id", "text").collect():
        left.setdefault(d.doc_id, []).append(library.encode(d.text or "", add_special_tokens=False).ids + [2])
    for doc_id, copies in left.items():
        pieces = [p for p in got if p["doc_id"] == doc_id]
        assert sum(p["length"] for p in pieces) == sum(map(len, copies))
        for p in pieces:
            ids = np.array(copies[0][p["start"]:p["start"] + p["length"]], "<u4")
            assert p["doc_tokens"] == len(copies[0]) and p["ids_crc32"] == zlib.crc32(ids.tobytes())
    sequences = {}
    for p in got:
        sequences.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= packing.WINDOW
    assert rows(packing.packed(nothing)) == []


def test_best_cuts_is_optimal():
    rng = random.Random(3)
    for _ in range(30):
        places = np.array([0, *sorted(rng.sample(range(1, 60), 12))])
        places = places[np.concatenate(([True], np.diff(places) > 0))]
        costs = np.array([0] + [rng.choice([0, 3]) for _ in places[1:]])
        window = 32

        def price(a, b):
            n = int(places[b] - places[a])
            return (0 if n & (n - 1) == 0 else window - n) + int(costs[b]) + packing.SEQUENCE_COST if n <= window else math.inf
        best = [0] + [math.inf] * (len(places) - 1)
        for j in range(1, len(places)):
            best[j] = min(best[i] + price(i, j) for i in range(j))
        if best[-1] < math.inf:
            cuts = [0, *packing.best_cuts(places, costs, window)]
            at = [places.tolist().index(c) for c in cuts]
            assert sum(price(a, b) for a, b in zip(at, at[1:])) == best[-1]


@pytest.mark.parametrize("share", [token_counts.SHARE, 1e-2])
def test_token_counts(docs, nothing, share):
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(tokenizer_path(token_counts.TOKENIZER))
    want = []
    for d in docs.select("doc_id", "text").collect():
        n = len(library.encode(d.text or "", add_special_tokens=False).ids)
        want.append((d.doc_id, len((d.text or "").encode()), n, n > 512))
    got = [tuple(r.values()) for r in rows(token_counts.token_counts(docs, share=share))]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert rows(token_counts.token_counts(nothing)) == []


def pre_tokens_of(cutter, texts):
    units, order, first, specials = cutter.units(pa.array(texts, pa.string()))
    tokens, which, several = cutter.tokens(units)
    tokens, end = tokens.to_pylist(), np.cumsum(several)
    lists = [[tokens[k] for k in which[e - n:e]] for e, n in zip(end, several)]
    return [[t for u in order[a:b] for t in lists[u]] for a, b in zip(first, first[1:])], specials.tolist()


def test_pre_tokens_are_those_of_the_library():
    cutter, rng = token_counts.PreTokenizer(token_counts.TOKENIZER), random.Random(3)
    letters = "abst''9  \n\t\r.-éß×÷ª\x1c\x85\u00a0\u1680\u2003\u2028\u200b\u3000\u180e“…日Σ\u0301\x00\u00ad😀٣ȿɐ"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 25))) for _ in range(5000)]
    got, specials = pre_tokens_of(cutter, texts)
    assert not any(specials)
    for text, tokens in zip(texts, got):
        assert tokens == [text[a:b] for _, (a, b) in cutter.library.pre_tokenizer.pre_tokenize_str(text)], repr(text)
    assert pre_tokens_of(cutter, ["<|endoftext|>a<|endoftext|>", "", " b"]) == ([["a"], [], [" b"]], [2, 0, 0])
    assert pre_tokens_of(cutter, []) == ([], [])


def test_usual_words_are_split_without_the_library():
    cutter = token_counts.PreTokenizer(token_counts.TOKENIZER)
    got, _ = pre_tokens_of(cutter, ["Grüße, él 12.5 (a-b)!\n\n  Une  fête\tou"])
    assert got == [["Grüße", ",", " él", " 12", ".", "5", " (", "a", "-", "b", ")!", "\n\n ", " Une", " ", " fête", "\t", "ou"]]
    assert not cutter.memo


@pytest.mark.parametrize("piece", [1, 100])
def test_token_counts_of_small_pieces(docs, monkeypatch, piece):
    want = sorted((tuple(r.values()) for r in rows(token_counts.token_counts(docs))), key=repr)
    column = pa.array([None, "", "one two", "three", "x" * 300, ""])
    monkeypatch.setattr(token_counts, "PIECE", piece)
    pieces = [p.to_pylist() for p in token_counts.in_pieces(column, piece)]
    assert sum(pieces, []) == ["", "", "one two", "three", "x" * 300, ""] and len(pieces) > 1
    assert sorted((tuple(r.values()) for r in rows(token_counts.token_counts(docs, share=1e-2))), key=repr) == want


class BruteTree:
    """The suffix tree of `suffix_tree` in dictionaries."""

    def __init__(self, streams, min_count):
        self.counts = {}
        for s in streams:
            for i in range(1, len(s)):
                for d in range(min(suffix_tree.DEPTH, i) + 1):
                    self.counts.setdefault(s[i - d:i], Counter())[s[i]] += 1
        self.states = {c for c, n in self.counts.items() if c and n.total() >= min_count and self.gain(c) > len(n)}

    def gain(self, context):
        n, above = self.counts[context], self.counts[context[1:]]
        return sum(k * math.log(k / n.total() / (above[x] / above.total())) for x, k in n.items())

    def p(self, context, symbol):
        if not context:
            n = self.counts.get(b"", Counter())
            return (n[symbol] + 0.5) / (n.total() + 0.5 * 256)
        p = self.p(context[1:], symbol)
        if context not in self.states:
            return p
        n = self.counts[context]
        return (n[symbol] + len(n) * p) / (n.total() + len(n))

    def score(self, s):
        return sum(math.log10(self.p(s[max(0, i - suffix_tree.DEPTH):i], s[i])) for i in range(1, len(s)))


def symbols_of(text):
    return b"\n" + b" ".join((text or "").encode().lower().split()) + b"\n"


@pytest.mark.parametrize("share, min_count, chunk_keys", [(suffix_tree.WORD_SHARE, 2, 500), (1e-2, 30, 1 << 22)])
def test_suffix_tree(spark, docs, nothing, share, min_count, chunk_keys):
    odd = [(900 + i, t, "en", "a", 1, None, None, None) for i, t in enumerate(["\0" * 50, "abc\0def", "abc def", "ÿþ \u0100"])]
    docs = docs.union(spark.createDataFrame(odd, DOCS))
    got = rows(suffix_tree.scored(docs, min_count, share, chunk_keys))
    given, counts = docs.select("doc_id", "text").collect(), Counter()
    held = {d.doc_id: zlib.crc32(("" if d.doc_id is None else str(d.doc_id)).encode()) % 5 == 1 for d in given}
    train = [symbols_of(d.text) for d in given if not held[d.doc_id]]
    for s in train:
        counts.update(s.split() + [b"\n"])
    n, v, tree = sum(counts.values()), len(counts), BruteTree(train, min_count)
    assert len(tree.states) > 40
    text = {d.doc_id: d.text for d in given}
    for r in got:
        s = symbols_of(text[r["doc_id"]])
        w = s.split() + [b"\n"]
        base = sum(math.log10((counts[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w)
        assert (r["held_out"], r["n_tokens"], r["train_tokens"]) == (held[r["doc_id"]], len(w), n)
        assert r["n_known"] == sum(counts[x] > 0 for x in w)
        assert r["base_score"] == pytest.approx(base) and r["score"] == pytest.approx(tree.score(s))
    assert len(got) == len(given) and rows(suffix_tree.scored(nothing)) == []


def test_suffix_tree_is_a_distribution(spark, docs):
    texts = [suffix_tree._stream(suffix_tree._words(d.text)) for d in docs.select("text").collect()]
    keys = Counter(int(k) for t in texts for k in (lambda x: x[suffix_tree._predicted(x)])(suffix_tree._keys(np.frombuffer(t, np.uint8))))
    contexts = {k & ~255 for k in random.Random(3).sample(sorted(keys), 40)}
    table = [(k, keys[k]) for k in {*keys, *(c | x for c in contexts for x in range(256))}]
    for min_count in (1, 2, 50, 10**9):
        found = {r.key: r.p for r in suffix_tree.probabilities(spark.createDataFrame(table, "key long, n long"), min_count).collect()}
        for c in contexts:
            assert sum(found[c | x] for x in range(256)) == pytest.approx(1)


def test_suffix_tree_counts_long_texts_in_parts():
    long = suffix_tree._stream([bytes(np.random.default_rng(1).integers(97, 100, 2 * suffix_tree._FOLD + 77, np.uint8))])
    short = suffix_tree._stream([b"abc", b"abd"])
    counts = suffix_tree._Counts()
    for stream, train in ((short, True), (long, True), (short, True), (short, False)):
        counts.add(stream, train)
    counts.fold()
    whole = np.concatenate([suffix_tree._keys(np.frombuffer(s, np.uint8)) for s in (long, short, short)])
    keys, n = np.unique(whole[suffix_tree._predicted(whole)], return_counts=True)
    assert (counts.keys == keys).all() and (counts.n == n).all()


def test_warc(spark):
    body = "<p>" + "x" * 200 + "é</p>"
    pages = [(1, "u", body), (2, None, body), (0, "a\r\nb", body), (3, "u", "short"), (4, "u", "short"), (5, "u", None), (None, "u", body)]
    df = spark.createDataFrame([(*p, "extra") for p in pages], "page_id long, url string, html string, digest string")
    got = {r["page_id"]: r for r in rows(warc.archived(df))}
    for page, _, html in pages:
        data, r = (html or "").encode(), got[page]
        revisit = html == body and page != 0
        assert (r["payload_bytes"], r["payload_digest"]) == (len(data), hashlib.sha256(data).hexdigest())
        assert (r["record_type"], r["refers_to"]) == (("revisit", 0) if revisit else ("response", None))
    assert rows(warc.archived(df.limit(0))) == []


def test_warc_payloads_come_back(spark, tmp_path):
    html = {i: f"<p>page {i}</p>" * (i + 20) for i in range(300)}
    df = spark.createDataFrame([(i, f"http://h/{i}", h) for i, h in html.items()], "page_id long, url string, html string")
    archives = warc.write_archives(df, str(tmp_path / "w"), archive_bytes=50_000)
    assert archives.count() > 1
    back = rows(warc.read_archives(archives, payload=True))
    assert {r["page_id"]: bytes(r["payload"]).decode() for r in back if r["record_type"] == "response"} == html


def test_vectors(spark):
    rng = np.random.default_rng(0)
    base = rng.normal(size=(40, 16))
    near = base[:10, None] + 0.02 * rng.normal(size=(10, 6, 16))
    data = [*base.tolist(), *near.reshape(-1, 16).tolist(), base[0].tolist(), (3 * base[1]).tolist()]
    odd = [None, [], [0.0] * 16, [float("nan")] + [1.0] * 15, [None] + [1.0] * 15, [float("inf")] + [1.0] * 15, [1.0, 2.0]]
    table = [(i, v, "x") for i, v in enumerate(data + odd)]
    df = spark.createDataFrame(table + [(None, data[0], "x")], "vec_id long, embedding array<double>, links string")
    got = {r["vec_id"]: r for r in rows(vector_graph.near_vectors(df))}
    x = np.array(data)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    link = x @ x.T >= 0.95
    np.fill_diagonal(link, False)
    reach = np.linalg.matrix_power((link | np.eye(len(x), dtype=bool)).astype(float), 8) > 0
    for i in range(len(data)):
        assert (got[i]["n_links"], got[i]["component_id"]) == (link[i].sum(), int(np.argmax(reach[i])))
    assert all((got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (0, i, True) for i in range(len(data), len(data + odd)))
    assert (got[None]["n_links"], got[None]["kept"]) == (0, False)
    assert rows(vector_graph.near_vectors(df.limit(0))) == []


def test_vector_blocks(spark, monkeypatch):
    monkeypatch.setattr(vector_graph, "SHARD", 20)
    rng = np.random.default_rng(1)
    data = 1 + 0.05 * rng.normal(size=(90, 8))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(data)], "vec_id long, embedding array<double>")
    got = rows(vector_graph.near_vectors(df))
    assert all((r["n_links"], r["component_id"]) == (89, 0) for r in got)


def grouped_vectors(group, pairs, width, size=64):
    """A dense group and separate pairs around it, at cosine 0.99 in a pair and 0.9 or less to all others."""
    rng = np.random.default_rng(4)
    unit = lambda v: v / np.linalg.norm(v, axis=-1, keepdims=True)
    centre = unit(rng.normal(size=size))
    around = unit(rng.normal(size=(pairs, size)))
    first = unit(centre + width * around)
    second = unit(first + 0.1 * unit(rng.normal(size=(pairs, size))))
    return np.concatenate((unit(centre + 0.01 * unit(rng.normal(size=(group, size)))), first, second))


def test_vector_search_leaves_a_dense_group():
    x = grouped_vectors(100, 130, 1.0)
    sims = x @ x.T
    within = sims >= 0.95
    np.fill_diagonal(within, False)
    assert within.sum() == 100 * 99 + 2 * 130
    found = vector_graph.range_search(sims, vector_graph.robust_prune(sims), 0.95)
    assert (found == within).all()


def test_vectors_of_a_shard_whose_search_fails_are_compared(spark, monkeypatch):
    x = grouped_vectors(20, 15, 1.0)
    table = [(i, v.tolist()) for i, v in enumerate(x)] + [(1000 + i, x[0].tolist()) for i in range(300)]
    df = spark.createDataFrame(table, "vec_id long, embedding array<double>")
    monkeypatch.setattr(vector_graph, "range_search", lambda sims, lists, cosine: np.zeros(sims.shape, bool))
    got = {r["vec_id"]: r["n_links"] for r in rows(vector_graph.near_vectors(df))}
    assert [got[i] for i in range(50)] == [319] * 20 + [1] * 30


def test_vector_audit_counts_queries_not_copies(spark, monkeypatch):
    x = grouped_vectors(1, 60, 1.0)
    ids = [100 * i for i in range(len(x))]
    table = [(i, v.tolist()) for i, v in zip(ids, x)] + [(100_000 + 100 * i, x[0].tolist()) for i in range(4000)]
    df = spark.createDataFrame(table, "vec_id long, embedding array<double>")
    monkeypatch.setattr(vector_graph, "PER_CLUSTER", 2)

    def apart(sample, k, *_):  # eight centres at every vector, so no pair has a cluster in common
        return sample[:1] if k == 1 else np.repeat(sample, 8, axis=0)
    monkeypatch.setattr(vector_graph, "centres", apart)
    got = {r["vec_id"]: r["n_links"] for r in rows(vector_graph.near_vectors(df))}
    assert sum(got[i] for i in ids[1:]) >= 0.97 * 120 and got[0] == 4000


@pytest.mark.parametrize("group", [1024, 2])
def test_repeats(docs, nothing, monkeypatch, group):
    monkeypatch.setattr(suffix_dedup, "GROUP", group)
    got = sorted((tuple(r.values()) for r in rows(suffix_dedup.without_repeats(docs))), key=repr)
    data = [(d.doc_id, (d.text or "").encode()) for d in docs.select("doc_id", "text").collect()]
    n = suffix_dedup.LENGTH
    seen = Counter(b[p:p + n] for _, b in data for p in range(len(b) - n + 1))
    want = []
    for doc_id, b in data:
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - n + 1):
            if seen[b[p:p + n]] > 1:
                gone[p:p + n] = True
        kept = bytes(c for c, g in zip(b, gone) if not g)
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        want.append((doc_id, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    assert got == sorted(want, key=repr) and rows(suffix_dedup.without_repeats(nothing)) == []


def test_pipeline(spark, docs, labels, tmp_path):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "private_data", "mix", "pack"]
    table = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        before = table.count()
        table = stage(spark, table, str(tmp_path))
        assert table.columns == docs.columns and table.count() <= before
    out = rows(corpus_pipeline.run(spark, str(tmp_path)))
    assert out and {p["doc_id"] for p in out} == {r["doc_id"] for r in rows(table)}
    json.dumps(out)


def test_word_encoder_equals_the_library_when_its_memo_overflows(monkeypatch):
    monkeypatch.setattr(packing, "MEMO", 3)
    encoder = packing.WordEncoder(packing.TOKENIZER)
    texts = [
        "one two three four five six", "two seven two one", "", "  \t\n", "don't it's 12 a.b! Ǻ é",
        "日本語 텍스트 one", "x y z w", "a\x1cb a", "<|endoftext|> one", "six five four three two one",
    ]
    for text in texts * 2:
        assert encoder(text).tolist() == encoder.library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("memo", [3, 10**6])
def test_new_words_are_encoded_as_the_library_does(monkeypatch, memo):
    monkeypatch.setattr(packing, "MEMO", memo)
    encoder = packing.WordEncoder(packing.TOKENIZER)
    assert encoder.splits
    rng = random.Random(2)
    letters = "abcXYZ'stmdl019.,!#&-_ éÉüßÿÀ×÷ªµ日İΣς\u0301\x00\x7f\n\u00ad"
    for _ in range(3000):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 30)))
        assert encoder(text).tolist() == encoder.library.encode(text, add_special_tokens=False).ids, repr(text)
