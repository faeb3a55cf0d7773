"""Personal data replaced by surrogates: keyed, of the same type and format, distinct, and the same everywhere.

Entities are found by patterns with validity checks.  An entity's surrogate is a
keyed hash of its normal form, written in the entity's own format: digits for
digits, letters for letters, a valid check digit for a valid one, a given name
of the same gender and script.  One pass gathers the distinct entities; those
whose surrogate another entity has, or is itself an entity of the corpus, get
the next attempt, round by round, until none collides; from attempt ``WIDE`` on
a surrogate may leave the exact count of characters, so that a full format does
not run out of values.  The second pass needs
only the few entities with an attempt over 0, joined to their documents, and
computes all other surrogates on the spot.
"""

from __future__ import annotations

import hashlib
import hmac
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import batch_of, read_table, text_slices
from tessera.session import write_table

# Names and forms of address by script and gender.
GIVEN = {
    ("latin", "f"): "Anna Maria Laura Julia Sophie Emma Clara Helena Paula Marta Lucia Elena Alice Nora Eva Irene Camille "
                    "Louise Carmen Ingrid".split(),
    ("latin", "m"): "Peter Paul Thomas Martin Daniel David Simon Lukas Felix Jonas Carlos Miguel Pablo Antoine Pierre Louis "
                    "Henri Robert Walter Oscar".split(),
    ("cyrillic", "f"): "Анна Мария Елена Ольга Наталья Ирина Татьяна Вера".split(),
    ("cyrillic", "m"): "Иван Пётр Павел Сергей Андрей Дмитрий Олег Борис".split(),
    ("greek", "f"): "Μαρία Ελένη Κατερίνα Σοφία Βασιλική Δήμητρα".split(),
    ("greek", "m"): "Γιώργος Νίκος Δημήτρης Κώστας Γιάννης Παναγιώτης".split(),
}
ADDRESS = {
    "f": "Mrs Ms Miss Frau Madame Mme Mademoiselle Mlle Señora Señorita Sra Srta Signora Senhora Mevrouw Fru MRS MS FRAU "
         "Госпожа госпожа Κυρία κυρία".split(),
    "m": "Mr Sir Herr Herrn Monsieur Señor Sr Signor Senhor Meneer MR HERR Господин господин Κύριος κύριος Κύριο κύριο".split(),
    "x": "Dr Dra Prof Professor Professorin Doctor Doktor Docteur DR Доктор доктор".split(),
}
#: Small words inside surnames, which stay.
PARTICLES = "von van der den de del della di da dos du la le ten ter zu zur el al bin ibn af".split()
SYLLABLES = {"latin": "ba den fel gar hol jan kes lor mer nau pel ros sten tur vin wal".split(),
             "cyrillic": "бар ден вол гор лан мир нов рад сев тур зор кел".split(),
             "greek": "βαρ δεν γαλ καρ λον μιρ νεφ πολ ραν στεν τορ φιλ".split()}
#: Length of an IBAN by country.
IBAN_LENGTH = {x[:2]: int(x[2:]) for x in (
    "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DK18 DO28 EE20 EG29 ES24 FI18 FO18 FR27 "
    "GB22 GE22 GI23 GL18 GR27 GT28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 LU20 LV21 LY25 MC27 "
    "MD24 ME22 MK19 MR27 MT31 MU30 NL18 NO15 PK24 PL28 PS29 PT25 QA29 RO24 RS22 SA24 SC31 SE24 SI19 SK24 SM27 ST25 SV28 TL23 "
    "TN24 TR26 UA29 VA22 VG24 XK20").split()}

KINDS = ("email", "phone", "ip", "card", "ssn", "iban", "name")
#: Attempts in the exact format of an entity; later ones are longer, or of any length for addresses of four numbers.
WIDE = 4
#: Attempts in all; an entity without a surrogate after so many is an error.
ATTEMPTS = 100
_DIGITS = re.compile(r"""
    (?<![\w.])(?P<ip>\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3})(?!\w|\.\d)
  | (?<!\w)(?P<iban>[A-Z]{2}\d{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?)(?!\w)
  | (?<![\w-])(?P<ssn>\d{3}-\d{2}-\d{4})(?![\w-])
  | (?<!\w)(?P<card>\d{4}(?P<gap>[\x20-])\d{4}(?P=gap)\d{4}(?P=gap)\d{1,7}|\d{13,19})(?!\w)
  | (?<!\w)(?P<phone>\+\d{1,3}[\x20.-]?(?:\(\d{1,4}\)[\x20.-]?)?\d{2,4}(?:[\x20.-]?\d{2,4}){1,4}
      |\(\d{3}\)\x20?\d{3}-\d{4}|\d{3}-\d{3}-\d{4})(?!\w)
""", re.X | re.A)
_MAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}")
_SOME_DIGIT = re.compile("[0-9]")


def _ranges(codes: list[int]) -> str:
    """Code points in order as ranges of a character class."""
    first = [c for c, before in zip(codes, [-2, *codes]) if c != before + 1]
    last = [c for c, after in zip(codes, [*codes[1:], -2]) if c != after - 1]
    return "".join(f"{chr(a)}-{chr(b)}" for a, b in zip(first, last))


#: Any letter but a small one.
_UP = rf"[^\W\d_{_ranges([c for c in range(0x20000) if chr(c).islower()])}]"
_CAP = rf"(?:{_UP}['’])?{_UP}[^\W\d_]+(?:-[^\W\d_]+)*"
_PART = rf"(?:{_UP}\.\x20?)*(?:(?:{'|'.join(PARTICLES)})\x20)*{_CAP}"
_TITLES = "|".join(x for v in ADDRESS.values() for x in v)
_GIVEN = "|".join(y for v in GIVEN.values() for x in v for y in (x, x.upper()))
_NAME = re.compile(rf"(?<!\w)(?:(?P<titles>(?:{_TITLES})(?:\.?\x20(?:{_TITLES}))*)\.?\x20(?P<called>{_PART}(?:\x20{_PART}){{0,2}})"
                   rf"|(?P<full>(?:{_GIVEN})(?:\x20(?:{_GIVEN}))*\x20{_PART}))(?!\w)")
_NAME_WORD = re.compile(_CAP)
_WORD = re.compile(r"(?<!\w)(?:[^\W\d_]['’])?[^\W\d_]+(?:-[^\W\d_]+)*(?!\w)")
_PIECE = re.compile(r"[^\W\d_]+")
_GENDER = {x.lower(): g for (_, g), v in GIVEN.items() for x in v}

#: (kind, start, end, normal form); names come part by part, as kinds given_f, given_m, given_x and surname.
Entity = tuple[str, int, int, str]


def luhn(digits: str) -> int:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) << (i & 1)
        total += d - 9 * (d > 9)
    return total % 10


def _mod97(iban: str) -> int:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


def _core(raw: str) -> str:
    return re.sub(r"[^A-Z0-9]", "", raw)


def _checked(kind: str, raw: str) -> tuple[int, str] | None:
    """(length, normal form) of the entity at the start of a match; groups at its end that are no part of it are left out."""
    ends = [len(raw)]
    if kind in ("iban", "phone"):
        ends += [i for i in range(len(raw) - 1, 0, -1) if raw[i] in (" " if kind == "iban" else " .-")]
    good = []
    for end in ends:
        core = raw[:end] if kind == "ip" else _core(raw[:end])
        if kind == "ip":
            ok = all(int(x) <= 255 for x in raw.split("."))
        elif kind == "iban":
            ok = (end == len(raw) or len(core) >= 15) and _mod97(core) == 1
        elif kind == "card":
            ok = 13 <= len(core) <= 19 and core[0] in "3456" and luhn(core) == 0
        elif kind == "phone":
            core = "+" * raw.startswith("+") + core
            ok = 8 <= len(core) <= 16 and (end == len(raw) or raw[end - 1].isdigit())
        else:
            ok = True
        if ok:
            good.append((end, core))
    return next((x for x in good if kind == "iban" and IBAN_LENGTH.get(x[1][:2]) == len(x[1])), good[0] if good else None)


def _numbers(text: str) -> Iterator[Entity]:
    """Entities with digits; what a match leaves is searched again."""
    at = 0
    while m := _DIGITS.search(text, at):
        kind = next(k for k in ("ip", "iban", "ssn", "card", "phone") if m[k] is not None)
        got = _checked(kind, m[0])
        if got:
            yield kind, m.start(), m.start() + got[0], got[1]
        at = m.start() + (got[0] if got else 1)


def _names(text: str) -> list[Entity]:
    """The parts of names, and their bare mentions elsewhere in the text.

    A bare mention is the word with its capital, or in capitals; a word that the text has in lower case more often
    is no name by itself.
    """
    out: list[Entity] = []
    alone: list[re.Match] = []
    roles: dict[str, str] = {}
    for m in _NAME.finditer(text):
        *first, last = _NAME_WORD.finditer(text, *m.span("called" if m["titles"] else "full"))
        titles = re.findall(r"\w+", m["titles"] or "")
        g = next((g for t in titles for g in "fm" if t in ADDRESS[g]), None)
        if not first:
            alone.append(last)
            continue
        for w in first:
            low = w[0].lower()
            out.append((f"given_{g or _GENDER.get(low, 'x')}", *w.span(), low))
        out.append(("surname", *last.span(), last[0].lower()))
        for kind, _, _, low in out[-len(first) - 1:]:
            roles.setdefault(low, kind)
    for w in alone:
        low = w[0].lower()
        out.append((roles.setdefault(low, "surname"), *w.span(), low))
    if not out:
        return out
    small: dict[str, int] = {}
    bare: dict[str, list[tuple[int, int]]] = {}
    for w in _WORD.finditer(text):
        whole = w[0].lower() in roles
        for s, e in [w.span()] if whole else [x.span() for x in _PIECE.finditer(text, *w.span())]:
            low = text[s:e].lower()
            if low in roles and text[s].islower():
                small[low] = small.get(low, 0) + 1
            elif low in roles:
                bare.setdefault(low, []).append((s, e))
    taken = {x[1] for x in out}
    for low, spans in bare.items():
        if small.get(low, 0) <= len(spans):
            out += [(roles[low], s, e, low) for s, e in spans if s not in taken]
    return out


def entities(text: str | None) -> list[Entity]:
    """The entities of a text, by start, not overlapping."""
    text = text or ""
    out: list[Entity] = []
    if "@" in text:
        out += [("email", *m.span(), m[0].lower()) for m in _mails(text)]
    if _SOME_DIGIT.search(text):
        out += _numbers(text)
    out += _names(text)
    out.sort(key=lambda e: (e[1], -e[2]))
    kept: list[Entity] = []
    for e in out:
        if not kept or e[1] >= kept[-1][2]:
            kept.append(e)
    return kept


def _mails(text: str) -> Iterator[re.Match]:
    """Matches of the address pattern, tried only around an @."""
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and (text[start - 1].isascii() and (text[start - 1].isalnum() or text[start - 1] in "._%+-")):
            start -= 1
        if start < at and (m := _MAIL.match(text, start)):
            yield m
            done = m.end()
        at = text.find("@", max(at + 1, done))


def _stream(key: bytes, label: str) -> Iterator[int]:
    """Numbers of 32 bits from a keyed hash."""
    n = 0
    while True:
        block = hmac.new(key, f"{label}|{n}".encode(), hashlib.sha256).digest()
        yield from (int.from_bytes(block[i:i + 4], "big") for i in range(0, 32, 4))
        n += 1


def _alike(core: str, rnd: Iterator[int]) -> str:
    return "".join("0123456789"[next(rnd) % 10] if c.isdigit() else "abcdefghijklmnopqrstuvwxyz"[next(rnd) % 26]
                   if "a" <= c <= "z" else "ABCDEFGHIJKLMNOPQRSTUVWXYZ"[next(rnd) % 26] if "A" <= c <= "Z" else c for c in core)


def script_of(word: str) -> str:
    return "cyrillic" if any("Ѐ" <= c <= "ӿ" for c in word) else "greek" if any("Ͱ" <= c <= "Ͽ" for c in word) else "latin"


def surrogate(kind: str, core: str, attempt: int, key: bytes, host_attempt: int = 0) -> str:
    """The normal form of the surrogate of an entity, at some attempt; an address has its host's surrogate."""
    rnd = _stream(key, f"{kind}|{core}|{attempt}")
    more = max(0, attempt - WIDE + 1)
    if kind == "host":
        host, _, top = core.rpartition(".")
        return f"{_alike(host + 'x' * more, rnd)}.{top}"
    if kind == "email":
        name, _, host = core.rpartition("@")
        # a host keeps one surrogate, whoever writes from it
        return f"{_alike(name + 'x' * more, rnd)}@{surrogate('host', host, host_attempt, key)}"
    if kind == "ip":
        if more:
            return ".".join(str(1 + next(rnd) % 254) for _ in range(4))
        low = {1: 1, 2: 10, 3: 100}
        return ".".join(str(low[len(x)] + next(rnd) % ({1: 9, 2: 90, 3: 155}[len(x)])) for x in core.split("."))
    if kind == "card":
        body = core[0] + _alike(core[1:-1] + "0" * min(more, 19 - len(core)), rnd)
        return body + str(next(d for d in range(10) if luhn(f"{body}{d}") == 0))
    if kind == "ssn":
        return str(1 + next(rnd) % 5) + _alike(core[1:] + "0" * more, rnd)
    if kind == "iban":
        body = _alike(core[4:] + "0" * min(more, max(0, 34 - len(core))), rnd)
        return f"{core[:2]}{98 - _mod97(core[:2] + '00' + body):02d}{body}"
    if kind == "phone":
        keep = 2 if core.startswith("+") else 0  # the sign and the first digit of the country
        return core[:keep] + (str(2 + next(rnd) % 8) if not keep else "") + _alike(core[keep or 1:] + "0" * min(more, 16 - len(core)), rnd)
    parts = SYLLABLES[script_of(core)]
    if kind == "surname":
        return "".join(parts[next(rnd) % len(parts)] for _ in range(3 + attempt))
    names = [x for g in ("fm" if kind[-1] == "x" else kind[-1]) for x in GIVEN[script_of(core), g]]
    return names[next(rnd) % len(names)].lower() + "".join(parts[next(rnd) % len(parts)] for _ in range(attempt))


def written(kind: str, raw: str, core: str, new: str) -> str:
    """The surrogate in the format of ``raw``."""
    if kind.startswith("given") or kind == "surname":
        return new.upper() if raw.isupper() and len(raw) > 1 else new.title()
    if kind == "ip":
        return new
    it = iter(new)
    out = []
    for c in raw:
        if c.isalnum() or c == "+" and core.startswith("+") or kind == "email":
            x = next(it)
            out.append(x.upper() if c.isupper() else x)
        else:
            out.append(c)
    return "".join([*out, *it])


_OCC = pa.schema([("doc", pa.int64()), ("th", pa.int64()), ("kind", pa.string()), ("core", pa.string())])


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for at, texts in text_slices(b.column(2)):
            rows = []
            for i, t in enumerate(texts):
                own = {(e[0], e[3]) for e in entities(t)}
                own |= {("host", core.rpartition("@")[2]) for kind, core in own if kind == "email"}
                rows += [(b.column(0)[at + i].as_py(), b.column(1)[at + i].as_py(), *e) for e in sorted(own)]
            if rows:
                yield batch_of(_OCC, [list(c) for c in zip(*rows)])


def _attempts(key: bytes):
    schema = pa.schema([("kind", pa.string()), ("core", pa.string()), ("attempt", pa.int32()), ("new", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            k, c, a = (b.column(j).to_pylist() for j in range(3))
            new = [surrogate(*x, key) for x in zip(k, c, a)]
            # hosts are entities of their own, so addresses need only differ from those of the same host
            new = [n[:n.index("@")] + x[x.index("@"):] if kind == "email" else n for kind, x, n in zip(k, c, new)]
            yield batch_of(schema, [k, c, a, new])

    return run


def _space(kind):
    """Kinds whose surrogates are written alike: all parts of names are one."""
    return F.when(kind.startswith("given") | (kind == "surname"), "name").otherwise(kind)


def resolve(found: DataFrame, key: bytes) -> DataFrame:
    """(kind, core, attempt, new) of the distinct entities in ``found`` (kind, core): no two share a surrogate, and
    none is an entity of the corpus, within a kind, and over all kinds of names.

    ``new`` of an address has the host it had, as hosts (kind ``host``) have surrogates of their own.
    """
    form = "kind string, core string, attempt int, new string"
    own, _ = write_table(found.select("kind", "core").distinct(), "entities")
    taken = own.select(_space(F.col("kind")).alias("k2"), F.col("core").alias("c2")).distinct()
    now, _ = write_table(own.withColumn("attempt", F.lit(0)).mapInArrow(_attempts(key), form), "surrogates")
    for _ in range(ATTEMPTS):
        now = now.withColumn("space", _space(F.col("kind")))
        first = now.groupBy("space", "new").agg(F.min(F.struct("attempt", "core", "kind")).alias("f"), F.count("*").alias("n"))
        first = first.filter("n > 1").select(F.col("space").alias("k1"), F.col("new").alias("n1"), "f")
        marked = (now.join(first, (F.col("space") == F.col("k1")) & (F.col("new") == F.col("n1")), "left")
                  .join(taken, (F.col("space") == F.col("k2")) & (F.col("new") == F.col("c2")), "left"))
        marked, _ = write_table(marked.select("kind", "core", "attempt", "new", (
            F.col("c2").isNotNull() | (F.col("f").isNotNull() & ((F.col("f.core") != F.col("core")) | (F.col("f.kind") != F.col("kind")))))
            .alias("bad")), "surrogates")
        if marked.filter("bad").isEmpty():
            return now.drop("space")
        again = (marked.filter("bad").select("kind", "core", (F.col("attempt") + 1).alias("attempt"))
                 .mapInArrow(_attempts(key), form))
        now, _ = write_table(marked.filter("not bad").drop("bad").unionByName(again), "surrogates")
    raise RuntimeError(f"entities without a free surrogate after {ATTEMPTS} attempts")


def replace_private_data(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``new_text`` and ``kinds``, the kind of each replaced entity in order.

    Nulls and edges: a null text stays null and has no kinds; rows with a null id and repeated rows are treated
    like others; other columns pass through (those named like the new ones are replaced); an empty table gives an
    empty result.  A text is held whole in a task.
    """
    secret = key.encode()
    docs = docs.drop("new_text", "kinds")
    slim = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("doc"),
                       F.xxhash64(text_col).alias("th"), F.col(text_col).alias("text"))
    found, _ = write_table(slim.mapInArrow(_occurrences, "doc long, th long, kind string, core string"), "private")
    later, _ = write_table(resolve(found, secret).filter("attempt > 0").select(
        F.col("kind").alias("k1"), F.col("core").alias("c1"), "attempt"), "laterattempts")
    later, _ = write_table(
        found.join(later, (F.col("kind") == F.col("k1")) & (F.col("core") == F.col("c1"))).groupBy("doc", "th")
        .agg(F.collect_set(F.struct("kind", "core", "attempt")).alias("later"))  # entities of one document
        .select(F.col("doc").alias("__doc"), F.col("th").alias("__th"), F.col("later").alias("__later")), "laterdocs")
    own = F.coalesce(F.col(f"d.`{id_col}`").cast("long"), F.lit(-(1 << 63)))
    both = docs.alias("d").join(later.alias("l"), (own == F.col("l.__doc")) & (F.xxhash64(F.col(f"d.`{text_col}`")) == F.col("l.__th")),
                                "left").select("d.*", F.col("l.__later"))
    at_text = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at, texts in text_slices(b.column(at_text)):
                new, kinds = [], []
                for text, more in zip(texts, b.column(b.num_columns - 1).slice(at, len(texts))):
                    tries = {(x["kind"], x["core"]): x["attempt"] for x in more.as_py() or ()}
                    out, done, ks = [], 0, []
                    for kind, s, e, core in entities(text):
                        host = tries.get(("host", core.rpartition("@")[2]), 0) if kind == "email" else 0
                        new_core = surrogate(kind, core, tries.get((kind, core), 0), secret, host)
                        out += [text[done:s], written(kind, text[s:e], core, new_core)]
                        done = e
                        ks.append("name" if kind.startswith(("given", "surname")) else kind)
                    new.append(text if text is None else "".join([*out, text[done:]]))
                    kinds.append(ks)
                part = b.slice(at, len(texts))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array(new, pa.string()), pa.array(kinds, pa.list_(pa.string()))],
                    names=[*b.schema.names[:-1], "new_text", "kinds"])

    return both.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("new_text", T.StringType()),
                                              T.StructField("kinds", T.ArrayType(T.StringType()))]))


def op3_private_data(spark, sf_dir: str) -> DataFrame:
    out = replace_private_data(read_table(spark, sf_dir, "documents").select("doc_id", "text"), key="surrogates of the corpus")
    def count(kind: str):
        return F.size(F.filter("kinds", lambda k: k == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(k) for k in KINDS]
    return out.select("doc_id", F.size("kinds").cast("long").alias("n_entities"), *counts, F.col("new_text").alias("text"))
