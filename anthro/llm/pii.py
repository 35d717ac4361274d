"""Surrogates for personal data: keyed, type-consistent, one to one.

Detected: e-mail addresses, secrets (values given to token, password, key ...),
IPv4 addresses, card numbers, phone and social security numbers, and person
names after a title or after a listed given name.

A surrogate is drawn from a keyed hash of (type, canonical value, attempt).  It
keeps the type's form: digits stay digits with the same separators, a card
number keeps its length, first digit and whether its check digit holds, an
address stays public or private, letters keep script and case, a given name
keeps gender and script.  The canonical value leaves out writing differences
(case, separators), so every mention of an entity, in whichever document, gets
the same surrogate.

Distinctness is checked over the whole corpus: draws that equal another
entity's surrogate, or a real value of the type, are drawn again with the next
attempt, until no two collide.  Only entities with a later attempt must be known
when texts are rewritten; up to ``max_sent`` of them go to the workers, more
are joined by text.

Defined results: null and empty texts stay; null ids and repeated rows are kept;
all columns are kept, and ``n_private`` (with underscores before it if taken)
counts the replaced mentions; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anthro.llm.common import arrow_schema, column, free_name, record_batch, stage

MAX_SENT = 100_000
ROUNDS = 60

# Titles, and given and family names to draw from, by script and gender.
TITLES = {"m": ["Mr", "Sir", "Herr", "Monsieur", "Señor", "Sr", "Signor", "г-н", "господин"],
          "f": ["Mrs", "Ms", "Miss", "Madam", "Frau", "Madame", "Mme", "Señora", "Sra", "Signora", "г-жа", "госпожа"]}
GIVEN = {
    ("latin", "m"): ["Adam", "Albert", "Anton", "Brian", "Carl", "Daniel", "David", "Edward", "Felix", "George", "Henry", "Hugo", "Ivan", "James",
                     "John", "Karl", "Leon", "Louis", "Marco", "Martin", "Michael", "Oscar", "Paul", "Peter", "Robert", "Simon", "Thomas", "Victor"],
    ("latin", "f"): ["Agnes", "Alice", "Anna", "Clara", "Diana", "Elena", "Elisabeth", "Emma", "Eva", "Grace", "Helen", "Ida", "Irene", "Jane",
                     "Julia", "Laura", "Linda", "Lucy", "Maria", "Marie", "Mary", "Nina", "Nora", "Paula", "Rosa", "Sarah", "Sofia", "Vera"],
    ("cyrillic", "m"): ["Алексей", "Андрей", "Борис", "Виктор", "Дмитрий", "Иван", "Михаил", "Николай", "Олег", "Павел", "Сергей", "Юрий"],
    ("cyrillic", "f"): ["Анна", "Вера", "Дарья", "Елена", "Ирина", "Мария", "Наталья", "Ольга", "Полина", "Светлана", "Татьяна", "Юлия"],
}
FAMILY = {
    "latin": ["Adler", "Archer", "Barker", "Becker", "Bishop", "Carter", "Castel", "Duran", "Fischer", "Fuller", "Garner", "Hansen", "Keller", "Lambert",
              "Leroy", "Marsh", "Mercer", "Molina", "Navarro", "Palmer", "Reeve", "Romero", "Sawyer", "Steiner", "Turner", "Vidal", "Wagner", "Weaver"],
    "cyrillic": ["Белов", "Волков", "Громов", "Зимин", "Карпов", "Крылов", "Лебедев", "Морозов", "Орлов", "Павлов", "Соколов", "Фролов"],
}

_IP = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_NAME = r"[^\W\d_][^\W\d_]+(?:[-'’][^\W\d_]+)*"
_TITLED = "|".join(sorted((re.escape(t) for g in TITLES.values() for t in g), key=len, reverse=True))
_GIVEN = "|".join(sorted({n for names in GIVEN.values() for n in names}, key=len, reverse=True))
PATTERN = re.compile(
    r"(?P<email>[^\W_][\w.+\-]*@[^\W_][\w\-]*(?:\.[^\W_][\w\-]*)+)"
    r"|(?i:\b(?:token|secret|password|passwd|api[_-]?key|access[_-]?key)\b[\"']?\s*[:=]\s*[\"']?)(?P<secret>[A-Za-z0-9+/_=\-]{8,})"
    rf"|(?<![\w.])(?P<ip>(?:{_IP}\.){{3}}{_IP})(?!\w|\.\d)"
    r"|(?<!\d)(?P<card>\d{13,19}|\d{4}(?P<sep>[ \-])\d{4}(?P=sep)\d{4}(?P=sep)\d{1,7}|\d{4}[ \-]\d{6}[ \-]\d{5})(?!\d)"
    r"|(?<![\w\-])(?P<ssn>\d{3}-\d{2}-\d{4})(?![\w\-])"
    r"|(?<![\w+])(?P<phone>\+\d{1,3}[ .\-]?(?:\(\d{1,4}\)[ .\-]?)?\d{2,4}(?:[ .\-]?\d{2,4}){1,4}|\(\d{3}\)[ .\-]?\d{3}[ .\-]?\d{4}|\d{3}[.\-]\d{3}[.\-]\d{4})(?!\d)"
    rf"|\b(?P<title>{_TITLED})\b\.?[ ](?P<name1>{_NAME})(?:[ ](?P<name2>{_NAME}))?"
    rf"|\b(?P<given>{_GIVEN})[ ](?P<family>{_NAME})")
_HINT = re.compile(rf"[@\d]|(?i:token|secret|passw|key)|\b(?:{_TITLED}|{_GIVEN})\b")


def script_of(word: str) -> str:
    for c in word:
        if c.isalpha():
            return "cyrillic" if "CYRILLIC" in unicodedata.name(c, "") else "latin"
    return "latin"


def gender_of(given: str) -> str | None:
    """Gender of a listed given name, whatever its case."""
    for (_, g), names in GIVEN.items():
        if given.title() in names:
            return g
    return None


def find(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, type, canonical value) of the entities of a text, in order."""
    if not text or not _HINT.search(text):
        return []
    out = []
    for m in PATTERN.finditer(text):
        kind = m.lastgroup if m.lastgroup not in ("sep", "name1", "name2", "family") else None
        if kind is None:
            kind = next(k for k in ("card", "title", "given") if m.group(k))
        if kind in ("title", "given"):
            if kind == "title":
                gender = next(g for g, t in TITLES.items() if m["title"] in t)
                words = [("name1", "given"), ("name2", "family")] if m["name2"] else [("name1", "family")]
            else:
                gender, words = gender_of(m["given"]), [("given", "given"), ("family", "family")]
            if not all(m[g][:1].isupper() for g, _ in words):
                if kind == "title" and m["name1"][:1].isupper():
                    words = [("name1", "family")]
                else:
                    continue
            for group, part in words:
                value = m[group].casefold()
                out.append((*m.span(group), f"given-{gender}" if part == "given" else "family", f"{script_of(value)}:{value}"))
        elif kind in ("card", "phone", "ssn"):
            out.append((*m.span(kind), kind, re.sub(r"\D", "", m[kind])))
        else:
            out.append((*m.span(kind), kind, m[kind].lower() if kind == "email" else m[kind]))
    return out


# ---------------------------------------------------------------- drawing

class _Stream:
    """Uniform numbers from a keyed hash."""

    def __init__(self, key: bytes, *parts: object):
        self.key, self.seed, self.n, self.pool = key, "\x1f".join(map(str, parts)).encode(), 0, b""

    def below(self, n: int) -> int:
        while True:
            if len(self.pool) < 4:
                self.pool += hashlib.blake2b(self.seed + self.n.to_bytes(4, "big"), key=self.key, digest_size=64).digest()
                self.n += 1
            x, self.pool = int.from_bytes(self.pool[:4], "big"), self.pool[4:]
            if x < (1 << 32) // n * n:
                return x % n

    def like(self, c: str) -> str:
        """A character of the same class."""
        if c.isdigit():
            return str(self.below(10))
        if "a" <= c <= "z":
            return chr(97 + self.below(26))
        if "A" <= c <= "Z":
            return chr(65 + self.below(26))
        if "а" <= c.lower() <= "я":
            x = chr(0x430 + self.below(32))
            return x.upper() if c.isupper() else x
        if c.isalpha():
            x = "àáâäçèéêëìíîïñòóôöùúûü"[self.below(22)]
            return x.upper() if c.isupper() else x
        return c


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _private(octets: list[int]) -> int:
    """How many leading octets say that an address is not public (0: public)."""
    a, b = octets[:2]
    if a in (0, 10, 127) or a >= 224:
        return 1
    return 2 if (a, b) in ((192, 168), (169, 254)) or a == 172 and 16 <= b <= 31 else 0


@lru_cache(maxsize=50_000)
def draw(key: bytes, kind: str, value: str, attempt: int) -> str:
    """Canonical surrogate of a canonical value."""
    s = _Stream(key, kind, value, attempt)
    if kind == "email":
        local, _, domain = value.partition("@")
        d = _Stream(key, "domain", domain, attempt // 4)
        *labels, top = domain.split(".")
        return "".join(map(s.like, local)) + "@" + ".".join(["".join(map(d.like, x)) for x in labels] + [top])
    if kind == "secret":
        low, up = (re.fullmatch(p, value) is not None for p in (r"[0-9a-f\-]+", r"[0-9A-F\-]+"))
        if low or up:
            x = "".join(c if c == "-" else "0123456789abcdef"[s.below(16)] for c in value)
            return x if low else x.upper()
        return "".join(map(s.like, value))
    if kind == "ip":
        octets = [int(x) for x in value.split(".")]
        fixed = _private(octets)
        while True:
            out = octets[:fixed] + [s.below(256) for _ in range(4 - fixed)]
            if _private(out) == fixed:
                return ".".join(map(str, out))
    if kind == "card":
        body = value[0] + "".join(str(s.below(10)) for _ in value[1:-1])
        right = next(c for c in "0123456789" if luhn(body + c))
        return body + (right if luhn(value) else str((int(right) + 1 + s.below(9)) % 10))
    if kind in ("phone", "ssn"):
        keep = max(0, len(value) - 10) if kind == "phone" else 0
        first = str(1 + s.below(9)) if keep == 0 else str(2 + s.below(8))
        return value[:keep] + first + "".join(str(s.below(10)) for _ in value[keep + 1:])
    script, _, _ = value.partition(":")
    pool = GIVEN[script, kind[-1]] if kind.startswith("given") else FAMILY[script]
    parts = 1 + attempt // 3  # the pool is small: later attempts draw double names
    return f"{script}:" + "-".join(pool[s.below(len(pool))] for _ in range(parts)).casefold()


def written(kind: str, surrogate: str, original: str) -> str:
    """The surrogate as the mention was written: its separators and case."""
    if kind in ("card", "phone", "ssn"):
        digits = iter(surrogate)
        return "".join(next(digits) if c.isdigit() else c for c in original)
    if kind == "email":
        return surrogate.upper() if original.isupper() else "".join(
            x.upper() if o.isupper() else x for x, o in zip(surrogate, original, strict=False)) + surrogate[len(original):]
    if kind.startswith("given") or kind == "family":
        name = surrogate.partition(":")[2]
        return name.upper() if original.isupper() else name.title()
    return surrogate


def rewrite(text: str | None, key: bytes, attempts: dict) -> tuple[str | None, int]:
    found = find(text or "")
    if not found:
        return text, 0
    out, at = [], 0
    for start, end, kind, value in found:
        out += [text[at:start], written(kind, draw(key, kind, value, attempts.get((kind, value), 0)), text[start:end])]
        at = end
    return "".join(out) + text[at:], len(found)


# ---------------------------------------------------------------- corpus

_DRAWN = "kind string, value string, attempt int, surrogate string"


def entities(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Distinct (kind, value) of the corpus, stored."""
    arrow = arrow_schema("kind string, value string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = {(k, v) for t in column(b, "text") for _, _, k, v in find(t.as_py() or "")}
            yield record_batch(sorted(rows), arrow)

    return stage(docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, "kind string, value string").distinct(), "entities")


def _drawn(table: DataFrame, key: bytes) -> DataFrame:
    arrow = arrow_schema(_DRAWN)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = zip(*(column(b, c).to_pylist() for c in ("kind", "value", "attempt")), strict=True)
            yield record_batch([(k, v, a, draw(key, k, v, a)) for k, v, a in rows], arrow)

    return table.select("kind", "value", "attempt").mapInArrow(run, _DRAWN)


def assign(found: DataFrame, key: bytes) -> DataFrame:
    """(kind, value, attempt, surrogate): surrogates distinct within a kind, none a real value; stored."""
    names = found.select("kind", F.col("value").alias("surrogate"))
    settled = None
    todo = found.withColumn("attempt", F.lit(0))
    for _ in range(ROUNDS):
        new = stage(_drawn(todo, key), "drawn")
        best = new.groupBy("kind", "surrogate").agg(F.min("value").alias("value"))
        good = best.join(names, ["kind", "surrogate"], "left_anti")
        if settled is not None:
            good = good.join(settled.select("kind", "surrogate"), ["kind", "surrogate"], "left_anti")
        kept = stage(new.join(good, ["kind", "surrogate", "value"], "left_semi").select(*new.columns), "settled")
        settled = kept if settled is None else settled.unionByName(kept)
        todo = stage(new.join(kept, ["kind", "value"], "left_anti").withColumn("attempt", F.col("attempt") + 1).select("kind", "value", "attempt"), "again")
        if todo.isEmpty():
            return settled
    raise RuntimeError(f"surrogates still collide after {ROUNDS} rounds")


def anonymise(docs: DataFrame, key: str, text_col: str = "text", max_sent: int = MAX_SENT) -> DataFrame:
    """``docs`` with every detected entity replaced, and the count column ``n_private``."""
    secret = hashlib.sha256(key.encode()).digest()
    late = stage(assign(entities(docs, text_col), secret).where("attempt > 0").select("kind", "value", "attempt"), "late")
    count = free_name(docs, "n_private")
    if late.count() <= max_sent:
        sent = docs.sparkSession.sparkContext.broadcast({(r.kind, r.value): r.attempt for r in late.collect()})

        @F.pandas_udf("struct<text: string, n: int>")
        def replaced(texts):
            import pandas as pd

            return pd.DataFrame([rewrite(t, secret, sent.value) for t in texts], columns=["text", "n"]).astype({"n": "int32"})

        pair = replaced(F.col(text_col).cast("string"))
        held = free_name(docs, "_replaced")
        return docs.withColumn(held, pair).withColumns({text_col: F.col(f"{held}.text"), count: F.col(f"{held}.n")}).drop(held)
    return _joined(docs, late, secret, text_col, count)


def _joined(docs: DataFrame, late: DataFrame, secret: bytes, text_col: str, count: str) -> DataFrame:
    """The same with later attempts joined by a hash of the text: more entities than one task should hold."""
    mentions = "text_key bigint, kind string, value string"
    arrow = arrow_schema(mentions)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = {(k, e[2], e[3]) for k, t in zip(column(b, "text_key").to_pylist(), column(b, "text"), strict=True) for e in find(t.as_py() or "")}
            yield record_batch(sorted(rows), arrow)

    key, extra = free_name(docs, "text_key"), free_name(docs, "_late")
    text = F.col(text_col).cast("string")
    per_text = (docs.select(F.xxhash64(text).alias("text_key"), text.alias("text")).mapInArrow(run, mentions).distinct()
                .join(late, ["kind", "value"]).groupBy("text_key").agg(F.collect_list(F.struct("kind", "value", "attempt")).alias(extra))
                .withColumnRenamed("text_key", key))

    @F.pandas_udf("struct<text: string, n: int>")
    def replaced(texts, lates):
        import pandas as pd

        out = [rewrite(t, secret, {} if x is None else {(e["kind"], e["value"]): e["attempt"] for e in x}) for t, x in zip(texts, lates, strict=True)]
        return pd.DataFrame(out, columns=["text", "n"]).astype({"n": "int32"})

    held = free_name(docs, "_replaced")
    wide = docs.withColumn(key, F.xxhash64(text)).join(per_text, key, "left").withColumn(held, replaced(text, F.col(extra)))
    return wide.withColumns({text_col: F.col(f"{held}.text"), count: F.col(f"{held}.n")}).drop(held, key, extra)
