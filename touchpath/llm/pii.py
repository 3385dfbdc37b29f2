"""Surrogates for personal data, on DataFrame functions only.

Entities found in a text are replaced by made-up ones of the same type: an e-mail address
by an e-mail address, ``+1 (217) 555-0134`` by digits in the same layout, a card number
that passes the Luhn test by another that does, ``Mrs Weber`` by a name of the same
gender, script and case. A replacement follows from a secret key, the type and the
canonical form (lower case, or digits without layout), so one entity has one replacement
in all texts and layouts, without a table that would have to be kept.

A name is found after a title; later and earlier bare mentions of its words in the same
text are replaced too. A surname alone has one form whatever the title. Names without any
titled mention in their text are not found.

Collision check: a replacement may be no entity of the data itself, nor that of another
entity. Of entities with the same candidate the smallest keeps it; the others, and those
whose candidate really occurs, try again with the next attempt number; every fourth
attempt makes names one syllable longer, so there are always free ones.

Occurrences are joined to replacements on the entity, where a frequent entity is split
over tasks; they return to their document as one small list, so a text moves once.

NULL texts stay NULL, texts without entities are unchanged byte for byte. Rows equal in id
and text get the same result. Entities are never looked for across rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchpath.llm.common import bound, settled, written

# What counts as an entity, in order of precedence.
MALE = "Mr|Herr|Sr|Sir|Monsieur|Señor|Господин"
FEMALE = "Mrs|Ms|Miss|Frau|Mme|Mlle|Sra|Srta|Madame|Señora|Госпожа"
EITHER = "Dr|Prof"
_SECRET = r"^.*?[=:]\s?[\"']?"
_NAME = r"\p{Lu}[\p{L}'’-]*\p{L}"
PATTERNS = {
    "email": r"(?<![\w.%+-])[\w.%+-]++@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}",
    "access_key": r"\b(?:AKIA|ASIA)[0-9A-Z]{16}\b",
    "hex_secret": r"(?<![0-9A-Za-z])(?=[a-f]*[0-9])[0-9a-f]{32,64}(?![0-9A-Za-z])",
    "password": r"(?i:password|passwd|pwd|secret|api_key)\s?[=:]\s?[\"']?[^\s\"'=:]{6,64}",
    "iban": r"\b[A-Z]{2}[0-9]{2}(?: ?[0-9A-Z]{4}){3,7}(?: ?[0-9A-Z]{1,3})?\b",
    "ipv4": r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\.?\d)",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "phone": r"(?<![\w+])(?:\+\d{1,3}[ .-]?(?:\(\d{2,4}\)|\d{2,4})(?:[ .-]?\d{2,4}){2,3}"
             r"|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4})(?![\w-])",
    "card": r"(?<![\w.-])[3-6]\d{3}(?:[ -]?\d{4}){2}[ -]?\d{1,7}(?![\w-])",
    "name": rf"\b(?:{MALE}|{FEMALE}|{EITHER})\.? {_NAME}(?: {_NAME})?",
}
# Every entity has one of these in it; a text without them is passed over quickly.
HINT = r"[0-9@=:]|(?:M(?:rs?|s|iss|me|lle|adame|onsieur)|Herr|Frau|S(?:ra?|rta|ir|eñora?)|Dr|Prof|Господин|Госпожа)\.? \p{Lu}"
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
# Characters at the front of the canonical form that a replacement keeps.
KEPT_FRONT = {"access_key": 4, "iban": 2, "phone": 1, "card": 1}
# Rule for names: two syllables and an ending for the gender, in the script of the name.
SYLLABLES = {
    "latin": "ba be bo da de do fa fe ga go ha he ka ko la le lo ma me mi mo na ne no pa ra re ro sa so ta to",
    "cyrillic": "ба бо ва во га го да до жа за зо ка ко ла ло ма ме ми мо на не но па ра ре ро са со та то фа хо",
}
ENDINGS = {
    ("latin", "male"): "bert mund win rik ton vard lek ron",
    ("latin", "female"): "lina ria nella beth dora tilde mina sia",
    ("latin", "either"): "ley rin sen ner well low ford mer",
    ("cyrillic", "male"): "слав мир тон рик лев дар вин ром",
    ("cyrillic", "female"): "лина рия нелла дора мила сия вета ника",
    ("cyrillic", "either"): "ленко рин сен нер вич ков ман мер",
}


def kind_of(value: Column) -> Column:
    """Type of a found string: the first pattern it matches as a whole."""
    tests = [(k, p) for k, p in PATTERNS.items() if k != "password"]
    return F.coalesce(*[F.when(value.rlike(f"^(?:{p})$"), k) for k, p in tests], F.lit("password"))


def canonical(kind: Column, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    plain = F.regexp_replace(value, "[^0-9A-Za-z]", "")
    name = F.lower(F.regexp_replace(value, rf"^(?:{MALE}|{FEMALE}|{EITHER})\.? ", ""))
    gender = F.when(~name.contains(" "), "either").when(value.rlike(rf"^(?:{MALE})\b"), "male").when(value.rlike(rf"^(?:{FEMALE})\b"), "female").otherwise("either")
    return (
        F.when(kind == "email", F.lower(value))
        .when(kind.isin("phone", "card", "ssn"), digits)
        .when(kind == "name", F.concat_ws(":", gender, name))
        .when(kind == "password", F.regexp_replace(value, _SECRET, ""))
        .when(kind.isin("iban", "access_key"), plain).otherwise(value)
    )


def _digest(key: str, *parts: Column) -> Column:
    """128 keyed pseudo-random bytes in hex."""
    text = F.concat_ws("\u0001", F.lit(key), *[p.cast("string") for p in parts])
    return F.concat(*[F.sha2(F.concat(text, F.lit(f"\u0001{i}")), 256) for i in range(4)])


def _byte(digest: Column, i: Column) -> Column:
    return F.conv(F.substring(digest, F.pmod(i, F.lit(128)) * 2 + 1, F.lit(2)), 16, 10).cast("int")


def _scrambled(kind: Column, canon: Column, digest: Column) -> Column:
    """Another string with digits, small and capital letters at the same places."""
    front = F.coalesce(*[F.when(kind == k, n) for k, n in KEPT_FRONT.items()], F.lit(0))
    tail = F.when(kind == "email", F.length(F.substring_index(canon, ".", -1)) + 1).otherwise(0)

    def pick(letters: str, b: Column) -> Column:
        return F.substring(F.lit(letters), F.pmod(b, F.lit(len(letters))) + 1, F.lit(1))

    def one(c: Column, i: Column) -> Column:
        b = _byte(digest, i)
        return (
            F.when((i < front) | (i >= F.length(canon) - tail), c)
            .when(kind == "hex_secret", pick("0123456789abcdef", b))
            .when((kind == "phone") & ((i == front) | (i == front + 3)), pick("23456789", b))
            .when(c.rlike("[0-9]"), pick("0123456789", b))
            .when(c.rlike("[a-z]"), pick("abcdefghijklmnopqrstuvwxyz", b))
            .when(c.rlike("[A-Z]"), pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ", b))
            .when(c.rlike(r"\p{L}"), pick("abcdefghijklmnopqrstuvwxyz", b)).otherwise(c)
        )
    return F.array_join(F.transform(F.split(canon, ""), one), "")


def _luhn_sum(digits: Column) -> Column:
    """Sum of the Luhn test over all digits, the last one counted singly."""
    def part(c: Column, i: Column) -> Column:
        d = c.cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return F.when(F.pmod(F.length(digits) - i, F.lit(2)) == 0, twice).otherwise(d)
    return F.aggregate(F.transform(F.split(digits, ""), part), F.lit(0), lambda a, x: a + x)


def _with_luhn(canon: Column, made: Column) -> Column:
    """The made number, its last digit mended where the original passes the test."""
    head = F.substring(made, F.lit(1), F.length(made) - 1)
    check = F.pmod(10 - F.pmod(_luhn_sum(F.concat(head, F.lit("0"))), F.lit(10)), F.lit(10))
    valid = F.pmod(_luhn_sum(canon), F.lit(10)) == 0
    return F.when(valid, F.concat(head, check.cast("string"))).otherwise(made)


def _name(key: str, canon: Column, attempt: Column) -> Column:
    """A made name for each word of the name; a last word is a surname for any gender."""
    gender = F.substring_index(canon, ":", 1)
    script = F.when(canon.rlike(r"\p{IsCyrillic}"), "cyrillic").otherwise("latin")

    def word(w: Column, i: Column, n: Column) -> Column:
        role = F.when(i + 1 < n, gender).otherwise(F.lit("either"))

        def at(d: Column, values: str, k: int) -> Column:
            options = values.split()
            return F.element_at(F.array(*map(F.lit, options)), F.pmod(_byte(d, F.lit(k)), F.lit(len(options))) + 1)

        def longer(d: Column, values: str) -> Column:
            more = F.when(attempt >= 4, F.sequence(F.lit(4), F.lit(3) + F.floor(attempt / 4).cast("int"))).otherwise(
                F.array().cast("array<int>"))
            options = values.split()
            return F.array_join(F.transform(more, lambda k: F.element_at(
                F.array(*map(F.lit, options)), F.pmod(_byte(d, k), F.lit(len(options))) + 1)), "")
        return F.initcap(bound(_digest(key, F.lit("name"), w, attempt), lambda d: F.coalesce(*[
            F.when((script == s) & (role == g), F.concat(
                *[at(d, SYLLABLES[s], k) for k in range(3)], longer(d, SYLLABLES[s]), at(d, end, 3)))
            for (s, g), end in ENDINGS.items()
        ])))
    words = F.split(F.substring_index(canon, ":", -1), " ")
    return F.array_join(F.transform(words, lambda w, i: word(w, i, F.size(words))), " ")


def _octets(digest: Column) -> Column:
    b = [_byte(digest, F.lit(i)) for i in range(4)]
    return F.concat_ws(".", F.pmod(b[0], F.lit(223)) + 1, b[1], b[2], F.pmod(b[3], F.lit(254)) + 1)


def made_up(key: str, kind: Column, canon: Column, attempt: Column) -> Column:
    """Candidate replacement of a canonical form."""
    def other(digest: Column) -> Column:
        plain = bound(_scrambled(kind, canon, digest), lambda made: F.when(kind == "card", _with_luhn(canon, made)).otherwise(made))
        return F.when(kind == "ipv4", _octets(digest)).otherwise(plain)
    return F.when(kind == "name", _name(key, canon, attempt)).otherwise(
        bound(_digest(key, kind, canon, attempt), other))


def rendered(kind: Column, value: Column, made: Column) -> Column:
    """The replacement in the layout and case of the found string."""
    def place(c: Column, i: Column, fill: Column) -> Column:
        before = F.length(F.regexp_replace(F.substring(value, F.lit(1), i + 1), "[^0-9A-Za-z]", ""))
        new = F.substring(fill, before, F.lit(1))
        return F.when(~c.rlike("[0-9A-Za-z]"), c).when(c.rlike("[A-Z]"), F.upper(new)).otherwise(new)
    refilled = bound(F.regexp_replace(made, "[^0-9A-Za-z]", ""), lambda fill: F.array_join(
        F.transform(F.split(value, ""), lambda c, i: place(c, i, fill)), ""))
    title = F.regexp_extract(value, rf"^(?:{MALE}|{FEMALE}|{EITHER})\.? ", 0)
    shout = F.regexp_replace(value, rf"^(?:{MALE}|{FEMALE}|{EITHER})\.? ", "").rlike(r"^[\p{Lu} ]{3,}$")
    name = F.concat(title, F.when(shout, F.upper(made)).otherwise(made))
    return (
        F.when(kind == "name", name)
        .when(kind == "password", F.concat(F.regexp_extract(value, _SECRET, 0), made))
        .when(kind.isin("email", "phone", "card", "ssn", "iban", "access_key"), refilled).otherwise(made)
    )


def bare_names(value: Column, made: Column) -> Column:
    """(old, new) of each word of a titled name, as found, with a capital and in capitals; old is a pattern."""
    words = F.split(F.regexp_replace(value, rf"^(?:{MALE}|{FEMALE}|{EITHER})\.? ", ""), " ")

    def forms(pair: Column) -> Column:
        def form(old: Column, new: Column) -> Column:
            return F.struct(F.concat(F.lit(r"(?<![\p{L}\p{N}_])\Q"), old, F.lit(r"\E(?!\p{L})")).alias("old"), new.alias("new"))
        old, new = pair["old"], pair["new"]
        found = F.when(old == F.upper(old), F.upper(new)).otherwise(new)
        return F.array(form(old, found), form(F.initcap(F.lower(old)), new), form(F.upper(old), F.upper(new)))
    pairs = F.zip_with(words, F.split(made, " "), lambda a, b: F.struct(a.alias("old"), b.alias("new")))
    return F.flatten(F.transform(pairs, forms))


def replacements(entities: DataFrame, key: str, max_attempts: int = 40) -> DataFrame:
    """(kind, canon, made) for distinct (kind, canon): distinct, and never an entity itself."""
    known = written(entities.select("kind", "canon").distinct(), "pii-entities")
    names = F.when(F.col("kind") == "name", F.substring_index("canon", ":", -1)).otherwise(F.col("canon"))
    real = known.select("kind", names.alias("made")).distinct()
    done, pending = None, known
    for attempt in range(max_attempts):
        tried = written(pending.withColumn("made", made_up(key, F.col("kind"), F.col("canon"), F.lit(attempt))), "pii-tried")
        lowered = F.when(F.col("kind") == "name", F.lower("made")).otherwise(F.col("made"))
        free = tried.withColumn("__made", lowered).join(
            real.withColumnRenamed("made", "__made"), ["kind", "__made"], "left_anti")
        if done is not None:
            free = free.join(done.select("kind", "made"), ["kind", "made"], "left_anti")
        won = free.groupBy("kind", "made").agg(F.min("canon").alias("canon")).select("kind", "canon", "made")
        won = written(won, "pii-won")
        done = won if done is None else done.union(won)
        pending = written(tried.drop("made").join(won, ["kind", "canon"], "left_anti"), "pii-pending")
        if pending.isEmpty():
            return done
    raise RuntimeError("no distinct replacements found; use longer forms")


def _rows(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col(doc_id).alias("id"), F.xxhash64(text).alias("hash"), F.col(text).alias("body"),
    )


def pseudonymized(docs: DataFrame, key: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``row`` (the input row), ``clean`` (the new text) and ``n_entities``, one row per input row."""
    rows = _rows(docs, doc_id, text)
    found = F.regexp_extract_all("body", F.lit(ANY), F.lit(0))
    hits = written(
        settled(rows.where(F.col("body").rlike(HINT)).select("id", "hash", "body"), "found", found)
        .select("id", "hash", "found").where(F.size("found") > 0)
        .dropDuplicates(["id", "hash"])
        .select("id", "hash", F.posexplode("found").alias("at", "value"))
        .withColumn("kind", kind_of(F.col("value")))
        .withColumn("canon", canonical(F.col("kind"), F.col("value"))),
        "pii-found",
    )
    table = replacements(hits, key)
    named = hits.join(table, ["kind", "canon"])
    no_names = F.array().cast("array<struct<old:string,new:string>>")
    names = F.when(F.col("kind") == "name", bare_names(F.col("value"), F.col("made"))).otherwise(no_names)
    lists = named.withColumn("new", rendered(F.col("kind"), F.col("value"), F.col("made"))).withColumn("names", names)
    lists = lists.groupBy("id", "hash").agg(F.array_sort(F.collect_list(F.struct("at", "new", "names"))).alias("all")).select(
        "id", "hash", F.transform("all", lambda x: x["new"]).alias("new"),
        F.array_distinct(F.flatten(F.transform("all", lambda x: x["names"]))).alias("names"))
    lists = lists.withColumnsRenamed({"id": "__id", "hash": "__hash"})
    on = rows["id"].eqNullSafe(lists["__id"]) & (rows["hash"] == lists["__hash"])
    joined = rows.join(lists.hint("shuffle_hash"), on, "left")
    between = F.when(F.col("new").isNotNull(), F.split("body", ANY, -1))
    parts = settled(joined.select("row", "body", "new", "names", between.alias("between")), "part", F.when(
        F.size("names") > 0, F.struct(
            F.transform("between", lambda t: F.aggregate("names", t, lambda a, x: F.regexp_replace(a, x["old"], x["new"]))).alias("between"),
            bound(F.array_join(F.transform("names", lambda x: x["old"]), "|"), lambda p: F.aggregate(
                "between", F.lit(0), lambda n, t: n + F.regexp_count(t, p))).alias("bare"),
        )).otherwise(F.struct(F.col("between").alias("between"), F.lit(0).alias("bare"))))
    woven = F.array_join(F.flatten(F.zip_with(
        F.col("part.between"), F.col("new"), lambda a, b: F.array(a, F.coalesce(b, F.lit("")))
    )), "")
    clean = F.when(F.col("new").isNull(), F.col("body")).otherwise(woven)
    count = F.coalesce(F.size("new") + F.col("part.bare"), F.lit(0)).cast("long")
    return parts.select("row", clean.alias("clean"), F.when(F.col("new").isNull(), 0).otherwise(count).alias("n_entities"))


def surrogate_report(docs: DataFrame, key: str) -> DataFrame:
    """doc_id, n_entities and the text with surrogates."""
    return pseudonymized(docs, key).select("row.doc_id", "n_entities", F.col("clean").alias("text"))


def replace_private(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with surrogates in ``text`` and ``n_chars`` brought up to date."""
    out = pseudonymized(docs, key)
    def column(c: str) -> Column:
        if c == "text":
            return F.col("clean").alias(c)
        if c == "n_chars":
            return F.length("clean").cast(docs.schema[c].dataType).alias(c)
        return F.col(f"row.`{c}`").alias(c)
    return out.select(*[column(c) for c in docs.columns])
