"""Personal data replaced by surrogates: keyed, of the same type and format, distinct and consistent.

*Detection*: e-mail addresses, IPv4 addresses, telephone numbers, card numbers (13 to 19 digits), values
of named secrets (6 characters or more, to the closing quote or white space), and names after one or
several titles, of any number of parts joined by blanks, hyphens or apostrophes. A value without quotes
may be prose or code: it counts as a secret with a digit, a sign such as ``$`` or ``_`` or a capital
behind a small letter, or with 8 characters after an equals sign. A name's parts are entities of their own: ``surname`` and
``given`` (with the gender that the title tells); once a name is introduced in a text, its parts are
replaced wherever they stand alone there, so that references stay together.

*Surrogates* are functions of the key, the entity and an attempt number. Numbers, addresses and secrets
go through a keyed permutation of their own shape (four Feistel rounds over the digits and letters),
which maps different entities of a shape to different ones: punctuation, length, country code, card
checksum, private or public address range and top-level domain stay as they were. Names get syllables
of their script with an ending of their gender. Capitals follow the original.

*Collision check*, over all distinct entities as a table: no two entities of a type may share a
surrogate, and no surrogate may be an entity of that type that occurs in the texts. Those in conflict
take their next attempt, until none is left; the smallest entity of a conflict keeps its own. Where
``MAX_ATTEMPTS`` do not suffice, names get longer and are assigned again; entities of other types get the
unused values of their shape (of an address, its first two octets) in order, and where a shape has none
left, a mark such as ``[ip 3]``. Entities beyond attempt 0 are the exceptions, broadcast when they are at
most ``MAX_EXCEPTIONS``, else joined to their documents; names get longer if theirs are more than that.

Defined results: NULL text stays NULL; text without entities is unchanged; the same entity has one
surrogate in all rows; repeated rows are rewritten alike.
"""

import hashlib
import re
import unicodedata
from collections import Counter
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .frames import append_columns, free_name, prepare, stored

MAX_EXCEPTIONS = 200_000
# Attempts before names get longer and other types get unused values.
MAX_ATTEMPTS = 10
# Attempt of an entity whose surrogate was assigned, not computed.
ASSIGNED = -1
TYPES = ("email", "ip", "phone", "card", "secret", "given_m", "given_f", "given_x", "surname")

# Titles and the gender they tell.
TITLES = {
    "Mr": "m", "Mister": "m", "Mrs": "f", "Ms": "f", "Miss": "f", "Dr": "x", "Prof": "x", "Herr": "m", "Frau": "f",
    "Monsieur": "m", "Madame": "f", "Mme": "f", "Señor": "m", "Señora": "f", "Sr": "m", "Sra": "f",
    "Господин": "m", "Госпожа": "f", "Κύριος": "m", "Κυρία": "f",
}
# Syllables of surrogate names by script, and endings by gender.
SYLLABLES = {
    "latin": ("ba", "be", "da", "do", "fa", "fe", "ga", "ha", "ja", "ka", "la", "le", "ma", "mi", "na", "no", "pa", "ra", "ri", "sa", "ta", "va"),
    "cyrillic": ("ба", "ве", "га", "да", "за", "ка", "ла", "ми", "на", "по", "ра", "се", "та", "фа"),
    "greek": ("βα", "γα", "δε", "ζα", "κα", "λα", "μι", "νο", "πα", "ρε", "σα", "τα"),
}
ENDINGS = {
    "latin": {"m": "ton", "f": "lina", "x": "ly", "s": "wick"},
    "cyrillic": {"m": "слав", "f": "лина", "x": "ша", "s": "ский"},
    "greek": {"m": "ρος", "f": "ρινα", "x": "λι", "s": "δης"},
}

_EMAIL = re.compile(r"(?<![\w.+-])[\w.+-]+@(?:[\w-]+\.)+(?:[^\W\d_]{2,}|xn--[\w-]+)(?![\w-])")
_IP = re.compile(r"(?<![\d.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![\d]|\.\d)")
_PHONE = re.compile(
    r"(?<![\w+])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)[ .-]?|[0-9]{2,4}[ .-])[0-9]{3,4}[ .-][0-9]{3,4}(?!\w)"
    # without separators after a plus, and in groups of two digits
    r"|(?<![\w+])\+[1-9][0-9]{7,14}(?!\w)|(?<![\w+.-])(?:\+[0-9]{1,3}[ .-]?[0-9]|0[0-9])(?:([ .-])[0-9]{2})(?:\1[0-9]{2}){3}(?![\w]|[.-][0-9])"
)
_CARD = re.compile(r"(?<!\d)[0-9]{13,19}(?!\d)|(?<![\d-])[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}(?!\d)")
# What every number of a kind below holds.
_NUMBER = re.compile(r"[0-9][0-9 .)-]")
# A quoted value runs to its closing quote, any other to white space; the punctuation after it stays.
_SECRET = re.compile(
    r"(?i)(?<!\w)(?:api[_-]?key|token|secret|password|passwd)[\"']?\s{0,3}([=:])\s{0,3}"
    r"(?:\"([^\"\r\n]{6,})\"|'([^'\r\n]{6,})'|[\"']?([^\s\"']{5,}[^\s\"',;.:!?)\]}>]))"
)
# What tells a value without quotes from a word of prose.
_MADE_UP = re.compile(r"\d|_|[^\w\s'’/.,;:!?()-]|[a-z][A-Z]")
# Letters joined by hyphens and apostrophes, without the s of a genitive.
_PART = r"[^\W\d_]+(?:-[^\W\d_]+|['’](?!s(?!\w))[^\W\d_]+)*"
_UPPER = r"(?![a-zà-öø-ÿа-яѐ-џα-ωά-ώ])"
_TITLE = "|".join(sorted(TITLES, key=len, reverse=True))
_NAME = re.compile(
    rf"(?<!\w)((?:{_TITLE})(?:\.? (?:{_TITLE})(?=[. ]))*)\.? ({_UPPER}(?=[^\W\d_]['’-]?[^\W\d_]){_PART}(?: {_UPPER}(?=[^\W\d_]['’-]?[^\W\d_]){_PART})*)"
)
_CAPITAL = re.compile(r"[^\W\d_]{2,}")
_JOINED = re.compile(rf"(?<!\w){_PART}(?!\w)")


def _luhn(digits: list[int]) -> int:
    """Check digit for the digits before it."""
    total = sum(d if i % 2 else (d * 2 - 9 if d > 4 else d * 2) for i, d in enumerate(reversed(digits)))
    return -total % 10


def _valid_ip(value: str) -> bool:
    return all(int(p) < 256 for p in value.split("."))


def _is_secret(m: re.Match) -> bool:
    """Whether the value of a named secret is none of prose or code."""
    sign, quoted, value = m[1], m[2] or m[3], m[4]
    return bool(quoted or _MADE_UP.search(value)) or (sign == "=" and len(value) >= 8)


def _gender(titles: str) -> str:
    """The gender that the first title with one tells."""
    return next((g for g in map(TITLES.get, re.findall(r"\w+", titles)) if g != "x"), "x")


def find(text: str) -> list[tuple[int, int, str, str]]:
    """(begin, end, type, entity) of the entities of a text, in order and without overlaps."""
    found = []
    if "@" in text:
        found += [(m.start(), m.end(), "email", m[0].lower()) for m in _EMAIL.finditer(text)]
    if "=" in text or ":" in text:
        found += [(*m.span(m.lastindex), "secret", m[m.lastindex]) for m in _SECRET.finditer(text) if _is_secret(m)]
    if _NUMBER.search(text):
        found += [(m.start(), m.end(), "ip", m[0]) for m in _IP.finditer(text) if _valid_ip(m[0])]
        found += [(m.start(), m.end(), "card", re.sub(r"\D", "", m[0])) for m in _CARD.finditer(text)]
        found += [
            (m.start(), m.end(), "phone", ("+" if m[0][0] == "+" else "") + re.sub(r"\D", "", m[0])) for m in _PHONE.finditer(text)
        ]
    parts = {}
    for m in _NAME.finditer(text) if any(t in text for t in TITLES) else ():
        names = m[2].split(" ")
        for i, name in enumerate(names):
            kind = "surname" if i == len(names) - 1 else f"given_{_gender(m[1])}"
            parts.setdefault(name.casefold(), kind)
    if parts:
        for m in _JOINED.finditer(text):
            kind = parts.get(m[0].casefold())
            if kind and not m[0][0].islower():
                found.append((m.start(), m.end(), kind, m[0].casefold()))
            elif not m[0].isalpha():  # a part beside a hyphen or an apostrophe
                for x in _CAPITAL.finditer(m[0]):
                    kind = parts.get(x[0].casefold())
                    if kind and not x[0][0].islower():
                        found.append((m.start() + x.start(), m.start() + x.end(), kind, x[0].casefold()))
    out, end = [], 0
    for item in sorted(found, key=lambda x: (x[0], -x[1])):
        if item[0] >= end:
            out.append(item)
            end = item[1]
    return out


def _stream(key: bytes, *parts) -> bytes:
    return hashlib.blake2b("\x00".join(map(str, parts)).encode(), key=key, digest_size=64).digest()


def _permuted(symbols: list[int], radices: list[int], key: bytes, tweak: str) -> list[int]:
    """Keyed permutation of the symbol strings with these radices."""
    half = len(symbols) // 2
    left, right = symbols[:half], symbols[half:]
    for i in range(4):
        moving, fixed, radix = (right, left, radices[half:]) if i % 2 == 0 else (left, right, radices[:half])
        moved = []
        for block in range(0, len(moving), 32):
            stream = _stream(key, tweak, i, block, *fixed)
            for j, (s, r) in enumerate(zip(moving[block : block + 32], radix[block : block + 32])):
                moved.append((s + int.from_bytes(stream[2 * j : 2 * j + 2], "big")) % r)
        left, right = (left, moved) if i % 2 == 0 else (moved, right)
    return left + right


@lru_cache(maxsize=100_000)
def _class_of(x: str) -> str:
    """The characters that may stand for one: ASCII digits, letters of a case, or letters of its kind in its script's block."""
    for c in ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"):
        if x in c:
            return c
    if ord(x) < 128 or not x.isalnum():
        return x

    def kind(c):
        return unicodedata.category(c), c.isalnum(), c.lower() == c, c.upper().lower() == c

    block = ord(x) & ~127
    return "".join(c for c in map(chr, range(block, block + 128)) if kind(c) == kind(x))


def _shaped(value: str, key: bytes, tweak: str) -> str:
    """Digits to digits, letters to letters of their script and case, hexadecimal strings to such; all else stays."""
    if re.fullmatch(r"[0-9a-f]{16,}", value):
        classes = ["0123456789abcdef"] * len(value)
    else:
        classes = [_class_of(x) for x in value]
    at = [(i, c) for i, c in enumerate(classes) if len(c) > 1]
    out = list(value)
    symbols = _permuted([c.index(value[i]) for i, c in at], [len(c) for _, c in at], key, tweak)
    for (i, c), s in zip(at, symbols):
        out[i] = c[s]
    return "".join(out)


def numbered(kind: str, entity: str, n: int) -> str | None:
    """The n-th value of an entity's shape, None beyond the last; values of one shape have the same ones."""
    if kind == "ip":
        a, b = entity.split(".")[:2]
        return f"{a}.{b}.{n >> 8}.{n & 255}" if n < 1 << 16 else None
    classes = [_class_of(x) for x in entity]
    if kind == "email":
        top = entity.rindex(".")
        classes[top:] = entity[top:]
    elif kind == "phone":
        first = 2 if entity[0] == "+" else 0
        classes[:first] = entity[:first]
        classes[first] = "23456789" if entity[first] > "1" else "01"
    elif kind == "card":
        classes[0] = entity[0]
        classes[-1] = "-"
    out = []
    for c in reversed(classes):
        n, place = divmod(n, len(c))
        out.append(c[place])
    if n:
        return None
    out = "".join(reversed(out))
    if kind == "card":
        off = (int(entity[-1]) - _luhn([int(d) for d in entity[:-1]])) % 10
        out = out[:-1] + str((_luhn([int(d) for d in out[:-1]]) + off) % 10)
    return out


def _script(name: str) -> str:
    point = ord(name[0])
    return "cyrillic" if 0x400 <= point < 0x530 else "greek" if 0x370 <= point < 0x400 else "latin"


def surrogate(key: bytes, kind: str, entity: str, attempt: int = 0, syllables: int = 3) -> str:
    """The surrogate of an entity, in the entity's canonical form."""
    tweak = f"{kind}/{attempt}"
    if kind == "email":
        local, domain = entity.split("@")
        name, top = domain.rsplit(".", 1)
        return _shaped(local, key, f"{tweak}/{domain}") + "@" + _shaped(name, key, f"domain/{attempt}") + "." + top
    if kind == "ip":
        octets = [int(p) for p in entity.split(".")]

        def group(o):
            return o[0] == 10 or o[:2] == [192, 168] or (o[0] == 172 and 16 <= o[1] < 32), o[0] == 127, o[0] in (0, 255) or o[0] >= 224

        if group(octets) == (False, False, False):
            new = _permuted(octets, [256] * 4, key, tweak)
            while group(new) != group(octets):
                new = _permuted(new, [256] * 4, key, tweak)
        else:  # the range stays, the host changes
            new = octets[:2] + _permuted(octets[2:], [256] * 2, key, tweak + "/".join(map(str, octets[:2])))
        return ".".join(map(str, new))
    if kind == "phone":
        code, rest = (entity[:2], entity[2:]) if entity[0] == "+" else ("", entity)
        digits = [int(d) for d in rest]
        new = _permuted(digits, [10] * len(digits), key, tweak + code)
        while (new[0] > 1) != (digits[0] > 1):
            new = _permuted(new, [10] * len(digits), key, tweak + code)
        return code + "".join(map(str, new))
    if kind == "card":
        digits = [int(d) for d in entity]
        off = (digits[-1] - _luhn(digits[:-1])) % 10
        new = digits[:1] + _permuted(digits[1:-1], [10] * (len(digits) - 2), key, f"{tweak}/{digits[0]}/{off}")
        return "".join(map(str, new)) + str((_luhn(new) + off) % 10)
    if kind == "secret":
        return _shaped(entity, key, tweak)
    script = _script(entity)
    own, number = SYLLABLES[script], int.from_bytes(_stream(key, tweak, entity)[:16], "big")
    out = ""
    for _ in range(syllables):
        number, place = divmod(number, len(own))
        out += own[place]
    return out + ENDINGS[script]["s" if kind == "surname" else kind[-1]]


def _dressed(kind: str, canonical: str, original: str) -> str:
    """A canonical surrogate in the punctuation and capitals of the original."""
    if canonical[0] == "[":
        return canonical
    if kind in ("phone", "card"):
        digits = iter(re.sub(r"\D", "", canonical))
        return "".join(next(digits) if c.isdigit() else c for c in original)
    if kind == "email" and len(canonical) == len(original):
        return "".join(c.upper() if o.isupper() and len(c.upper()) == 1 else c for c, o in zip(canonical, original))
    if kind in ("email", "ip", "secret"):
        return canonical
    if original.isupper() and len(original) > 1:
        return canonical.upper()
    return canonical[0].upper() + canonical[1:]


def entities(docs: DataFrame, text: str = "text") -> DataFrame:
    """Distinct (type, entity) of all texts."""
    prepare(docs.sparkSession)

    def run(batches):
        for batch in batches:
            seen = sorted({(kind, entity) for t in batch.column(0).to_pylist() if t for _, _, kind, entity in find(t)})
            yield pa.RecordBatch.from_arrays(
                [pa.array([s[0] for s in seen], pa.string()), pa.array([s[1] for s in seen], pa.string())], names=["type", "entity"]
            )

    return docs.select(F.col(text)).mapInArrow(run, "type string, entity string").distinct()


def _assigned(found: DataFrame, key: bytes, syllables: int) -> DataFrame:
    """type, entity and attempt with the surrogate of that attempt."""
    def make():
        def compute(batch):
            rows = zip(*(batch.column(n).to_pylist() for n in ("type", "entity", "attempt")))
            return (pa.array([surrogate(key, *row, syllables) for row in rows], pa.string()),)

        return compute

    return append_columns(found, "surrogate string", make)


def _conflicts(now: DataFrame) -> DataFrame:
    """Entities that must take another attempt."""
    shared = now.groupBy("type", "surrogate").agg(F.min("entity").alias("owner"), F.count(F.lit(1)).alias("n"))
    real = now.select("type", F.col("entity").alias("surrogate"), F.lit(True).alias("real"))
    judged = now.join(shared.where("n > 1").drop("n"), ["type", "surrogate"], "left").join(real, ["type", "surrogate"], "left")
    return judged.where("real or entity <> owner").select("type", "entity")


def _attempted(found: DataFrame, key: bytes, syllables: int) -> tuple[DataFrame, DataFrame | None]:
    """Entities after their attempts, and those still in conflict (None if there are none)."""
    now = stored(_assigned(found.withColumn("attempt", F.lit(0)), key, syllables), "pii-assigned")
    for i in range(MAX_ATTEMPTS + 1):
        again = stored(_conflicts(now), "pii-conflicts")
        if again.isEmpty():
            return now, None
        if i == MAX_ATTEMPTS:
            return now, again
        moved = now.drop("surrogate").join(again.withColumn("moved", F.lit(1)), ["type", "entity"], "left")
        moved = moved.select("type", "entity", (F.col("attempt") + F.coalesce("moved", F.lit(0))).cast("int").alias("attempt"))
        now = stored(_assigned(moved, key, syllables), "pii-assigned")


def _numbered(rows: DataFrame, column: str, value: str, n: str | None = None) -> DataFrame:
    """Rows with the n-th value (without ``n`` the first, which names the shape) of the shape of ``value``."""
    def make():
        def compute(batch):
            numbers = batch.column(n).to_pylist() if n else [0] * batch.num_rows
            return (pa.array(map(numbered, batch.column("type").to_pylist(), batch.column(value).to_pylist(), numbers), pa.string()),)

        return compute

    return append_columns(rows, f"{column} string", make)


def _with_unused(now: DataFrame, left: DataFrame) -> DataFrame:
    """All entities; those left in conflict get the unused values of their shape in order, then marks."""
    both = ["type", "entity"]
    kept = now.join(left, both, "left_anti")
    used = stored(_numbered(
        kept.select("type", F.col("surrogate").alias("value")).union(now.select("type", F.col("entity").alias("value"))).distinct(),
        "shape", "value",
    ), "pii-used")
    order = Window.partitionBy("type", "shape")
    need = _numbered(left, "shape", "entity").withColumn("rank", F.row_number().over(order.orderBy("entity")))
    need = stored(need, "pii-left")
    wanted = need.groupBy("type", "shape").agg(F.count(F.lit(1)).alias("n"))
    most = used.join(wanted, ["type", "shape"]).groupBy("type", "shape").agg((F.first("n") + F.count(F.lit(1))).alias("most"))
    tried = most.select("type", "shape", F.explode(F.sequence(F.lit(0).cast("long"), F.col("most"))).alias("number"))
    tried = _numbered(tried, "value", "shape", "number").where("value is not null").join(used.select("type", "value"), ["type", "value"], "left_anti")
    free = tried.withColumn("rank", F.row_number().over(order.orderBy("number"))).select("type", "shape", "rank", "value")
    given = need.join(free, ["type", "shape", "rank"], "left")
    mark = F.concat(F.lit("["), F.col("type"), F.lit(" "), F.row_number().over(Window.partitionBy("type").orderBy("entity")), F.lit("]"))
    found = given.where("value is not null").unionByName(given.where("value is null").withColumn("value", mark))
    new = found.select("type", "entity", F.lit(ASSIGNED).alias("attempt"), F.col("value").alias("surrogate"))
    return stored(kept.select("type", "entity", "attempt", "surrogate").union(new), "pii-assigned")


def assignment(docs: DataFrame, key: bytes, syllables: int = 3, text: str = "text") -> tuple[DataFrame, int]:
    """type, entity, attempt and surrogate of every entity, free of conflicts, and the length of names it took."""
    found = stored(entities(docs, text), "pii-entities")
    named = F.col("type").isin([t for t in TYPES if t == "surname" or t.startswith("given")])
    others, left = _attempted(found.where(~named), key, syllables)
    if left is not None:
        others = _with_unused(others, left)
    while True:
        names, left = _attempted(found.where(named), key, syllables)
        if left is None and names.where("attempt > 0").limit(MAX_EXCEPTIONS + 1).count() <= MAX_EXCEPTIONS:
            return others.select("type", "entity", "attempt", "surrogate").unionByName(names), syllables
        syllables += 1


def _joined(docs: DataFrame, late: DataFrame, text: str, name: str) -> DataFrame:
    """Documents with the exceptions among their own entities, for any number of exceptions."""
    row = free_name(docs, "row_id")
    rows = stored(docs.withColumn(row, F.monotonically_increasing_id()), "pii-rows")

    def run(batches):
        for batch in batches:
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                seen = sorted({x[2:] for x in find(t)}) if t else []
                columns = [pa.array([i] * len(seen), pa.int64())] + [pa.array([x[k] for x in seen], pa.string()) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays(columns, names=["_row", "type", "entity"])

    held = rows.select(row, text).mapInArrow(run, "_row long, type string, entity string").join(late, ["type", "entity"])
    own = held.groupBy("_row").agg(F.collect_list(F.struct("type", "entity", "attempt", "surrogate")).alias(name))
    return rows.join(own, F.col(row) == F.col("_row"), "left").drop(row, "_row")


def replaced(docs: DataFrame, key: bytes, text: str = "text", counts: str = "entity_counts") -> DataFrame:
    """Every row with its text rewritten, and how many entities of each type it held."""
    assigned, syllables = assignment(docs, key, text=text)
    wanted, own = docs.columns, free_name(docs, "exceptions")
    late = assigned.where("attempt <> 0").select("type", "entity", "attempt", "surrogate")
    few = late.limit(MAX_EXCEPTIONS + 1).count() <= MAX_EXCEPTIONS
    if not few:
        docs = _joined(docs, late, text, own)
    late = {(r.type, r.entity): (r.attempt, r.surrogate) for r in (late.collect() if few else ())}
    late = docs.sparkSession.sparkContext.broadcast(late)

    def make():
        everywhere, memo = late.value, {}

        def canonical(kind, entity, exceptions):
            if (kind, entity) in exceptions:
                return exceptions[kind, entity][1]
            if len(memo) > 100_000:
                memo.clear()
            if (kind, entity) not in memo:
                memo[kind, entity] = surrogate(key, kind, entity, 0, syllables)
            return memo[kind, entity]

        def compute(batch):
            texts, numbers = [], []
            given = batch.column(own).to_pylist() if not few else [None] * batch.num_rows
            for t, mine in zip(batch.column(text).to_pylist(), given):
                exceptions = {(x["type"], x["entity"]): (x["attempt"], x["surrogate"]) for x in mine} if mine else everywhere
                out, end, seen = [], 0, Counter()
                for begin, stop, kind, entity in find(t) if t else ():
                    out += [t[end:begin], _dressed(kind, canonical(kind, entity, exceptions), t[begin:stop])]
                    seen[kind] += 1
                    end = stop
                texts.append(t if not out else "".join(out) + t[end:])
                numbers.append([seen[k] for k in TYPES])
            fields = [pa.field(k, pa.int32()) for k in TYPES]
            columns = [pa.array([n[i] for n in numbers], pa.int32()) for i in range(len(TYPES))]
            return pa.array(texts, pa.string()), pa.StructArray.from_arrays(columns, fields=fields)

        return compute

    kinds = ", ".join(f"{k}: int" for k in TYPES)
    new = append_columns(docs, f"{text} string, {counts} struct<{kinds}>", make)
    return new.select(*wanted, counts)


def surrogate_table(docs: DataFrame, key: bytes = b"siftlake surrogate key") -> DataFrame:
    """doc_id, rewritten text and entity counts of every document."""
    found = replaced(docs.select("doc_id", "text"), key)
    n = sum((F.col(f"entity_counts.{k}") for k in TYPES[1:]), F.col(f"entity_counts.{TYPES[0]}"))
    return found.select("doc_id", "text", n.alias("n_entities"), *[F.col(f"entity_counts.{k}").alias(f"n_{k}") for k in TYPES])
