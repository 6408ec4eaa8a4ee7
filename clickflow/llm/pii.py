"""Personal data: detected entities get keyed surrogates of the same kind and format.

Detected are e-mail addresses, phone numbers, IP addresses, card and account numbers, IBANs,
social security numbers, secrets and persons (a title or a common given name before names). A
surrogate is drawn from a keyed hash of the entity's plain form (``canon``), so an entity gets
the same one wherever it stands and however it is written. It keeps lengths (but for entities
that drew often), separators, letter case and script; card numbers that satisfy their check digit still do, IBANs likewise; names
keep the gender of title or given name, and families stay families.

Collision checks: all different entities of the corpus are put together, and where two have one
surrogate, or a surrogate is an entity that exists, all but one draw again until all differ.
E-mails and names get longer with each attempt, secrets and numbers other than IP addresses with
each one after ``SAME_LENGTH``, so that all differ in the end, however few there are of a length.
Only entities that drew again travel back to their documents, as a map of each document's own.

Secrets without any letter or digit get other symbols; those of up to ``MASK`` different symbols
are no secrets (``********``, dots, the rule of a table).

Persons are found by a title or a common given name. Where a text names one in full, the same given
or family name standing alone in that text is the same person's and changes alike.

Defined results: null texts stay null, texts without findings stay as they are; overlapping
findings go to the kind that comes first in ``PATTERNS``; repeated rows change alike; texts are
read whole, and searched in time that grows with their length alone; an empty table gives no rows;
``n_chars`` is counted anew where there is such a column. ``private`` gives back exactly the input's
columns; ``with_surrogates`` adds ``n_entities`` and ``kinds`` in place of columns so named.
"""

from __future__ import annotations

import hashlib
import hmac
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from clickflow.llm.common import keep_table, small_side, table, text_batches

EXAMPLE_KEY = b"for trials and tests"  # real data needs a key of its own, kept secret
SAME_LENGTH = 8  # attempts
MASK = 3
SYMBOLS = "!#$%&()*+,-./:;<=>?@[]^_{|}~"
FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Mme", "Mlle", "Madame", "Señora", "Sra", "Signora", "г-жа", "госпожа")
MALE = ("Mr", "Herr", "Herrn", "Monsieur", "Señor", "Sr", "Signor", "г-н", "господин")
EITHER = ("Dr", "Prof")
GIVEN_FEMALE = ("Alice", "Anna", "Barbara", "Carmen", "Elena", "Emma", "Isabel", "Jennifer", "Julia", "Katharina",
                "Laura", "Linda", "Maria", "Marie", "Mary", "Patricia", "Sarah", "Sophie", "Susan")
GIVEN_MALE = ("Antonio", "Carlos", "Charles", "Daniel", "David", "Hans", "James", "Jean", "John", "José", "Juan",
              "Karl", "Michael", "Paul", "Peter", "Pierre", "Richard", "Robert", "Thomas", "William")
UP, LOW = "A-ZÀ-ÖØ-ÞА-ЯЁ", "a-zß-öø-ÿа-яё"
NAME = rf"[{UP}][{LOW}]+(?:-[{UP}][{LOW}]+)?"
DIGIT, WORDS = re.compile(r"\d"), re.compile(r"\w+")
# a title or given name begins with one of these as a whole run of word characters
PERSON_WORDS = frozenset(WORDS.match(w)[0] for w in (*FEMALE, *MALE, *EITHER, *GIVEN_FEMALE, *GIVEN_MALE))
# kind, whether it can occur at all in a text (quick to tell, never stricter than the pattern), pattern
PATTERNS = (
    ("secret", lambda text, digit: "-----BEGIN" in text, None),
    ("secret", lambda text, digit: max(map(len, text.split()), default=0) >= 20, re.compile(
        r"(?<![A-Za-z0-9])(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|sk-[A-Za-z0-9_-]{20,}"
        r"|[0-9a-f]{32,}|[0-9A-F]{32,})(?![A-Za-z0-9])")),
    ("secret", lambda text, digit: "=" in text or ":" in text, re.compile(
        r"(?i:token|secret|password|passwd|key)\s*[=:]\s*[\"']?([^\s\"']{8,})")),
    ("email", lambda text, digit: "@" in text, None),
    ("iban", lambda text, digit: digit, re.compile(
        r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b")),
    ("ip", lambda text, digit: digit or ":" in text, re.compile(
        r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d]|\.\d)"
        r"|(?<![\w:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![\w:])")),
    ("card", lambda text, digit: digit, re.compile(
        r"(?<!\d)(?:\d{13,19}|\d{4}([ -])\d{4}\1\d{4}\1\d{1,7}|\d{4}([ -])\d{6}\2\d{5})(?!\d)")),
    ("ssn", lambda text, digit: digit, re.compile(r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])")),
    ("phone", lambda text, digit: digit, re.compile(
        r"(?<![\w+])\+\d{1,3}[ .-]?(?:\(\d{1,5}\)[ .-]?)?\d{2,5}(?:[ .-]?\d{2,5}){1,4}(?!\d)"
        r"|(?<![\d(])\(\d{3}\) ?\d{3}[-.]\d{4}(?!\d)|(?<![\d.-])\d{3}[-.]\d{3}[-.]\d{4}(?![\d-])")),
    ("person", lambda text, digit: not PERSON_WORDS.isdisjoint(WORDS.findall(text)), re.compile(
        rf"\b(?P<title>{'|'.join((*FEMALE, *MALE, *EITHER))})\.? (?P<names>{NAME}(?: {NAME})?)"
        rf"|\b(?P<given>{'|'.join((*GIVEN_FEMALE, *GIVEN_MALE))}) (?P<family>{NAME})")),
)
KEY_BEGIN, KEY_END = (re.compile(rf"-----{word} [A-Z ]*PRIVATE KEY-----") for word in ("BEGIN", "END"))
LOCAL, DOMAIN = re.compile(r"[\w.%+-]+"), re.compile(r"@[^\W_](?:[\w-]*\.)+[^\W\d_]{2,}")
NOT_ALNUM = re.compile(r"[\W_]*")
BARE_NAME = re.compile(rf"\b{NAME}\b")
LEAST_NAME = 3
VOWELS = {"latin": "aeiou", "cyrillic": "аеиоу"}
CONSONANTS = {"latin": "bdfgklmnprstv", "cyrillic": "бвгдклмнпрст"}
ENDS = {("latin", "f"): "a", ("latin", "m"): "o", ("latin", "n"): "i", ("cyrillic", "f"): "а",
        ("cyrillic", "m"): "й", ("cyrillic", "n"): "и"}


def script_of(text: str) -> str:
    return "cyrillic" if any("Ѐ" <= c <= "ӿ" for c in text) else "latin"


@lru_cache(4096)
def kin(char: str) -> str:
    """The characters near ``char`` that are of its kind: category, script and folding are alike."""
    def traits(c: str) -> tuple:
        return unicodedata.category(c), unicodedata.name(c, "").split(" ")[0], c.casefold() == c

    if char.isdecimal():
        zero = ord(char) - unicodedata.decimal(char)
        return "".join(map(chr, range(zero, zero + 10)))
    start = ord(char) & ~127
    return "".join(c for c in map(chr, range(start, start + 128)) if traits(c) == traits(char))


def has_letters(text: str) -> bool:
    """Whether any character is a letter, mark or number."""
    return any(unicodedata.category(c)[0] in "LMN" for c in text)


def _plain(kind: str, text: str) -> str:
    """The form that all ways to write an entity share."""
    if kind in ("card", "ssn", "phone"):
        return "".join(str(unicodedata.decimal(c)) for c in text if c.isdecimal())
    if kind == "iban":
        return "".join(str(unicodedata.decimal(c)) if c.isdecimal() else c for c in text if c != " ")
    return text if kind == "secret" else text.casefold()


def _persons(match: re.Match) -> list[tuple[int, int, str]]:
    """The names of a person as given and family names with their gender."""
    if match["given"]:
        gender = "f" if match["given"] in GIVEN_FEMALE else "m"
        return [(*match.span("given"), "given_" + gender), (*match.span("family"), "family")]
    gender = "f" if match["title"] in FEMALE else "m" if match["title"] in MALE else "n"
    start, names = match.start("names"), match["names"].split(" ")
    if len(names) == 1:
        return [(*match.span("names"), "family")]
    middle = start + len(names[0])
    return [(start, middle, "given_" + gender), (middle + 1, match.end("names"), "family")]


def _private_keys(text: str) -> Iterator[tuple[int, int]]:
    at = 0
    while (begin := KEY_BEGIN.search(text, at)) and (end := KEY_END.search(text, begin.end())):
        yield begin.start(), end.end()
        at = end.end()


def _addresses(text: str) -> Iterator[tuple[int, int]]:
    """E-mail addresses, looked for outwards from each ``@``."""
    done = 0
    for run in LOCAL.finditer(text):
        start, at = max(run.start(), done), run.end()
        if start >= at or not text.startswith("@", at) or not text[at - 1].isalnum():
            continue
        domain = DOMAIN.match(text, at)
        if domain:
            done = domain.end()
            yield NOT_ALNUM.match(text, start).end(), done


def find(text: str | None) -> list[tuple[int, int, str, str]]:
    """``(start, end, kind, canon)`` of all entities in order, none overlapping."""
    if not text:
        return []
    taken: list[tuple[int, int, str]] = []
    marked = bytearray(len(text))
    digit = DIGIT.search(text) is not None
    names: dict[str, str] = {}

    def take(parts: list[tuple[int, int, str]]) -> bool:
        if marked.find(1, parts[0][0], parts[-1][1]) >= 0:
            return False
        marked[parts[0][0]:parts[-1][1]] = b"\1" * (parts[-1][1] - parts[0][0])
        taken.extend(parts)
        return True

    for kind, possible, pattern in PATTERNS:
        if not possible(text, digit):
            continue
        if pattern is None:
            for span in _private_keys(text) if kind == "secret" else _addresses(text):
                take([(*span, kind)])
            continue
        for match in pattern.finditer(text):
            parts = _persons(match) if kind == "person" else [
                (*match.span(1 if kind == "secret" and match.lastindex else 0), kind)]
            if kind == "secret" and len(set(text[slice(*parts[0][:2])])) <= MASK and not has_letters(
                    text[slice(*parts[0][:2])]):
                continue
            if take(parts) and kind == "person":
                for start, end, part in parts:
                    names.setdefault(text[start:end], part)
    if names:  # a person named in full is the same one where one name stands alone
        for match in BARE_NAME.finditer(text):
            if len(match[0]) >= LEAST_NAME and match[0] in names:
                take([(*match.span(), names[match[0]])])
    return [(s, e, kind, _plain(kind, text[s:e])) for s, e, kind in sorted(taken)]


def luhn(digits: str) -> int:
    """The sum that is divisible by 10 in a valid card number."""
    return sum(d if k % 2 == 0 else d * 2 - 9 * (d > 4) for k, d in enumerate(map(int, reversed(digits))))


class Draws:
    """An endless row of numbers from a keyed hash."""

    def __init__(self, key: bytes, *parts):
        self.key, self.seed, self.block, self.left = key, "\0".join(map(str, parts)), 0, b""

    def below(self, n: int) -> int:
        if len(self.left) < 4:
            self.left = hmac.new(self.key, f"{self.seed}\0{self.block}".encode("utf-8", "replace"), hashlib.sha256).digest()
            self.block += 1
        number, self.left = int.from_bytes(self.left[:4], "big"), self.left[4:]
        return number % n

    def like(self, char: str) -> str:
        """A character of the same kind."""
        for first, last in ("09", "az", "AZ", "ая", "АЯ"):
            if first <= char <= last:
                return chr(ord(first) + self.below(ord(last) - ord(first) + 1))
        if not has_letters(char):
            return char
        others = kin(char)
        return others[self.below(len(others))] if len(others) > 1 else self.like("a")

    def hex_like(self, char: str) -> str:
        return "0123456789abcdef"[self.below(16)] if char.islower() or char.isdigit() else "0123456789ABCDEF"[self.below(16)]


def surrogate(kind: str, canon: str, attempt: int = 0, key: bytes = EXAMPLE_KEY) -> str:
    """The canonical surrogate of an entity; further attempts give other ones."""
    draw = Draws(key, kind, canon, attempt)
    longer = max(0, attempt - SAME_LENGTH)
    if kind == "email":
        local, _, domain = canon.rpartition("@")
        more = "".join(draw.like("a") for _ in range(attempt))
        own = Draws(key, "domain", domain)
        labels = ["".join(own.like(c) for c in label) for label in domain.split(".")[:-1]]
        return "".join(draw.like(c) for c in local) + more + "@" + ".".join([*labels, "example"])
    if kind == "ip":
        if ":" in canon:
            return ":".join("".join(draw.hex_like(c) for c in part) for part in canon.split(":"))
        return ".".join(str(1 + draw.below(254)) for _ in range(4))
    if kind in ("card", "ssn", "phone"):
        kept = 1 if kind == "phone" else 0
        digits = canon[:kept] + "".join(draw.like(c) for c in canon[kept:] + "0" * longer)
        if kind == "card" and luhn(canon) % 10 == 0:
            digits = digits[:-1] + str(-luhn(digits[:-1] + "0") % 10)
        return digits
    if kind == "iban":
        body = "".join(draw.like(c) for c in canon[4:] + "0" * longer)
        number = int("".join(str(int(c, 36)) for c in body + canon[:2] + "00"))
        return f"{canon[:2]}{98 - number % 97:02d}{body}"
    if kind == "secret":
        if re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", canon):
            return "".join(draw.hex_like(c if c.isalpha() else "a" if canon.islower() else "A")
                           for c in canon + "0" * longer)
        if not has_letters(canon):
            return "".join(SYMBOLS[draw.below(len(SYMBOLS))] for _ in range(len(canon) + longer))
        return "".join(draw.like(c) for c in canon + "a" * longer)
    script = script_of(canon)
    syllables = 2 + draw.below(2) + attempt
    name = "".join(CONSONANTS[script][draw.below(len(CONSONANTS[script]))]
                   + VOWELS[script][draw.below(5)] for _ in range(syllables))
    if kind == "family":
        return name + CONSONANTS[script][draw.below(len(CONSONANTS[script]))]
    return name + CONSONANTS[script][draw.below(len(CONSONANTS[script]))] + ENDS[script, kind[-1]]


def written_like(kind: str, text: str, made: str) -> str:
    """The canonical surrogate in the format of the place it goes to."""
    if kind in ("card", "ssn", "phone", "iban"):
        rest, written = iter(made), []
        longer = len(made) - sum(c.isalnum() for c in text)
        for c in text + text[-1] * longer:
            new = next(rest) if c.isalnum() else c
            written.append(kin(c)[int(new)] if c.isdecimal() and new.isdecimal() else new)
        return "".join(written)
    if kind == "family" or kind.startswith("given"):
        return made.upper() if len(text) > 1 and text.isupper() else made.capitalize()
    return made.upper() if kind == "email" and text.isupper() else made


def replaced(text: str | None, attempts: dict, key: bytes = EXAMPLE_KEY) -> tuple[str | None, list]:
    """The text with surrogates, and the entities found."""
    found = find(text)
    if not found:
        return text, found
    parts, at = [], 0
    for start, end, kind, canon in found:
        made = surrogate(kind, canon, attempts.get((kind, canon), 0), key)
        parts += [text[at:start], written_like(kind, text[start:end], made)]
        at = end
    return "".join([*parts, text[at:]]), found


def text_key():
    return F.unhex(F.md5(F.coalesce(F.col("text"), F.lit(""))))


def mentions(texts: DataFrame) -> DataFrame:
    """``text_key, kind, canon``: each text's different entities."""
    def found(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = [(name, kind, canon) for name, text in zip(part["text_key"], part["text"])
                    for kind, canon in sorted({x[2:] for x in find(text)})]
            yield pd.DataFrame(rows, columns=["text_key", "kind", "canon"])

    return texts.where("text IS NOT NULL").select(text_key().alias("text_key"), "text").mapInPandas(
        found, "text_key binary, kind string, canon string")


def drawn_again(entities: DataFrame, key: bytes = EXAMPLE_KEY) -> DataFrame:
    """Entities ``(kind, canon, attempt)`` whose first surrogate was taken, all now different."""
    @F.pandas_udf(StringType())
    def made(kind: pd.Series, canon: pd.Series, attempt: pd.Series) -> pd.Series:
        return pd.Series([surrogate(*x, key) for x in zip(kind, canon, attempt)], dtype=object)

    drawn = keep_table(entities.select("kind", "canon", F.lit(0).alias("attempt")).withColumn(
        "made", made("kind", "canon", "attempt")), "pii-drawn")
    known = entities.select("kind", F.col("canon").alias("made")).distinct()
    while True:
        first = drawn.groupBy("kind", "made").agg(
            F.min(F.struct("attempt", "canon")).alias("first"), F.count("*").alias("n")).where("n > 1")
        doubled = drawn.join(first, ["kind", "made"]).where("canon <> first.canon").select("kind", "canon")
        real = drawn.join(known, ["kind", "made"], "left_semi").select("kind", "canon")
        again = keep_table(doubled.union(real).distinct().withColumn("again", F.lit(1)), "pii-again")
        if again.isEmpty():
            return drawn.where("attempt > 0").select("kind", "canon", "attempt")
        next_draw = drawn.join(again, ["kind", "canon"], "left").select(
            "kind", "canon", (F.col("attempt") + F.coalesce("again", F.lit(0))).alias("attempt"))
        drawn = keep_table(next_draw.withColumn("made", made("kind", "canon", "attempt")), "pii-drawn")


def _changed(docs: DataFrame, key: bytes) -> DataFrame:
    """``row`` (the whole row) and ``new``: the text with surrogates, ``n`` and ``kinds`` found."""
    text_batches(docs.sparkSession)
    seen = keep_table(mentions(docs), "pii-mentions")
    again = keep_table(drawn_again(seen.select("kind", "canon").distinct(), key), "pii-attempts")
    attempts = keep_table(seen.distinct().join(small_side(again, again.count()), ["kind", "canon"])
                          .groupBy("text_key").agg(F.collect_list(F.struct("kind", "canon", "attempt")).alias("own")),
                          "pii-own")

    @F.pandas_udf(StructType([StructField("text", StringType()), StructField("n", LongType()),
                              StructField("kinds", StringType())]))
    def changed(text: pd.Series, own: pd.Series) -> pd.DataFrame:
        rows = []
        for value, redraws in zip(text, own):
            tries = {(r["kind"], r["canon"]): r["attempt"] for r in redraws} if redraws is not None else {}
            new, found = replaced(value, tries, key)
            rows.append((new, len(found), ",".join(sorted({x[2].split("_")[0] for x in found}))))
        return pd.DataFrame(rows, columns=["text", "n", "kinds"])

    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), "text")
    if attempts.isEmpty():
        joined = rows.withColumn("own", F.lit(None).cast(attempts.schema["own"].dataType))
    else:
        joined = rows.withColumn("text_key", text_key()).join(
            small_side(attempts, attempts.count()), "text_key", "left")
    return joined.select("row", changed("text", "own").alias("new"))


def _columns(docs: DataFrame, without: tuple[str, ...] = ()) -> list:
    """The columns of the documents, ``text`` and ``n_chars`` as they are now."""
    now = {"text": F.col("new.text"), "n_chars": F.length("new.text").cast("bigint")}
    return [now.get(c.lower(), F.col("row")[c]).alias(c) for c in docs.columns if c.lower() not in without]


def with_surrogates(docs: DataFrame, key: bytes) -> DataFrame:
    """The documents with surrogates in ``text``, and ``n_entities`` and ``kinds`` found."""
    return _changed(docs, key).select(*_columns(docs, ("n_entities", "kinds")),
                                      F.col("new.n").alias("n_entities"), F.col("new.kinds").alias("kinds"))


def private(docs: DataFrame, key: bytes) -> DataFrame:
    """The documents with surrogates, with the columns they came with."""
    return _changed(docs, key).select(*_columns(docs))


def op3_pii(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return with_surrogates(docs, EXAMPLE_KEY).select("doc_id", "text", "n_entities", "kinds")
