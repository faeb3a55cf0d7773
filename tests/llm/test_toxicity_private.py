import itertools
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import private_data as pd_
from tessera.llm import toxicity as tx

from .conftest import DOC_SCHEMA, docs_rows


def test_marginals_match_enumeration():
    rng = np.random.default_rng(0)
    em, step = rng.normal(size=5), rng.normal(size=3)
    logs, want = {}, np.zeros(5)
    for ys in itertools.product((0, 1), repeat=5):
        s = sum(e for e, y in zip(em, ys) if y)
        s += sum({(0, 1): step[0], (1, 0): step[1], (1, 1): step[2]}.get(p, 0.0) for p in zip(ys, ys[1:]))
        logs[ys] = np.exp(s)
    for ys, w in logs.items():
        want += np.array(ys) * w / sum(logs.values())
    both = np.full((7, 2), np.nan)
    both[:5, 0] = em
    both[:2, 1] = em[:2]
    got = tx.marginals(both, step)
    assert got[:5, 0] == pytest.approx(want)
    assert got[:2, 1] == pytest.approx(tx.marginals(em[:2, None], step)[:, 0]) and (got[5:, 0] == 0).all()


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    model = tx.fit_on(docs, labels)
    out = (tx.toxicity(docs.select("doc_id", "text"), model).join(labels, "doc_id").filter("char_length(text) > 60")
           .select("doc_id", "score", "toxic").collect())
    held = [(r.score, r.toxic) for r in out if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    s, y = (np.array(x) for x in zip(*held))
    pairs = (s[y == 1][:, None] > s[y == 0][None, :]).mean()
    assert pairs > 0.93
    assert ((s >= tx.THRESHOLD) == y).mean() > 0.96


def test_toxicity_edges(spark, docs, clashing, no_docs):
    labels = spark.createDataFrame([(4, 1), (5, 0), (6, 0), (6, 0), (7, None), (None, 1)], "doc_id long, toxic int")
    texts = ["a nice day", "you idiot fool", "such an idiot here", "nothing here", "fine words"] * 8
    model = tx.fit(texts, [0, 1, 1, 0, 0] * 8)
    for d in (docs, clashing):
        m = tx.fit_on(d, labels)
        out = tx.toxicity(d, m).collect()
        assert len(out) == len(docs_rows()) and all(0 <= r.score <= 1 for r in out)
        assert tx.drop_toxic(d, labels).columns == d.columns
    assert tx.toxicity(no_docs, model).count() == 0
    nothing = spark.createDataFrame([], "doc_id long, toxic int")
    assert all(r.score == 0 for r in tx.toxicity(docs, tx.fit_on(docs, nothing)).collect())
    df = spark.createDataFrame([(1, "so nice\nwhat an  idiot é", "en", "s", 1)], DOC_SCHEMA)
    r = tx.toxicity(df, model).first()
    assert r.score > 0.5 and (r.starts, r.ends) == ([17], [22])


def test_entities():
    t = "Mail Bo.B+1@Mail7.Example.com, +1 (017) 555-7713, 97.51.17.173 999.1.1.1 4845168114407329 9807915762804490!! a@b"
    assert [(k, t[s:e]) for k, s, e, _ in pd_.entities(t)] == [
        ("email", "Bo.B+1@Mail7.Example.com"), ("phone", "+1 (017) 555-7713"), ("ip", "97.51.17.173"), ("card", "4845168114407329")]
    t = "Mrs. Anna Schmidt and Herr Müller met Пётр Иванов; DE89370400440532013000 078-05-1120 (555) 123-4567 x@y.z"
    assert [k for k, *_ in pd_.entities(t)] == ["given_f", "surname", "surname", "given_m", "surname", "iban", "ssn", "phone"]
    assert pd_.entities(None) == [] and pd_.entities("Licensed under 4.0. Version 3.") == []


def test_surrogates_keep_type_and_format():
    key = b"k"
    for t in ("a.b9@mail3.example.com", "+1 (017) 555-7713", "97.51.17.173", "4845-1681-1440-7329", "DE89 3704 0044 0532 0130 00",
              "078-05-1120", "(555) 123-4567"):
        (kind, s, e, core), = pd_.entities(t)
        new = pd_.written(kind, t, core, pd_.surrogate(kind, core, 0, key))
        assert new != t and len(new) == len(t)
        assert re.sub(r"[a-z]", "a", re.sub(r"\d", "9", new)) == re.sub(r"[a-z]", "a", re.sub(r"\d", "9", t))
        (kind2, *_), = pd_.entities(new)
        assert kind2 == kind
    for core, kind in (("anna", "given_f"), ("пётр", "given_m")):
        new = pd_.surrogate(kind, core, 0, key)
        assert new.title() in pd_.GIVEN[pd_.script_of(core), kind[-1]]
    assert pd_.script_of(pd_.surrogate("surname", "иванов", 2, key)) == "cyrillic"


def test_replacement_is_consistent_and_distinct(spark, docs, clashing, no_docs):
    cards = [r for i in range(3000) if pd_.luhn(r := f"4{i:014d}") == 0]
    ips = [f"1.2.{i % 9 + 1}.{j}" for i in range(9) for j in range(1, 10)]  # few of their format: many collisions
    rows = [(i, f"x {ip} y {cards[i % len(cards)]} z Mr Novak {ips[0]}", "en", "s", 1) for i, ip in enumerate(ips * 2)]
    out = pd_.replace_private_data(spark.createDataFrame(rows, DOC_SCHEMA).repartition(3), "k").collect()
    seen: dict = {}
    for r in out:
        old, new = ([m for m in re.findall(r"\S+", t)] for t in (r["text"], r["new_text"]))
        assert len(old) == len(new) and r["kinds"] == ["ip", "card", "name", "ip"]
        for a, b in zip(old, new):
            if a not in "xyzMr":
                assert seen.setdefault(a, b) == b
    assert len(set(seen.values())) == len(seen) and not set(seen) & set(seen.values())
    for d in (docs, clashing):
        got = pd_.replace_private_data(d, "k")
        assert set(d.columns) <= set(got.columns)
        assert sorted(((r["text"], r["new_text"]) for r in got.collect()), key=repr) == sorted(((r[1], r[1]) for r in docs_rows()), key=repr)
    assert pd_.replace_private_data(no_docs, "k").count() == 0


def test_numbers_before_other_words():
    for iban in ("BE68 5390 0754 7034", "AT611904300234573201", "ES9121000418450200051332", "DE89 3704 0044 0532 0130 00"):
        for after in (" BIC", " EUR", " EUR 250", " 2024 ABCD EFGH", "", ", paid"):
            assert [(k, f"{iban}{after}"[s:e]) for k, s, e, _ in pd_.entities(f"{iban}{after}")] == [("iban", iban)]
    t = "AC12 BE68 5390 0754 7034 BIC, 1234 4845 1681 1440 7329 and +44 20 7946 0958 2024 1000"
    assert [(k, t[s:e]) for k, s, e, _ in pd_.entities(t)] == [
        ("iban", "BE68 5390 0754 7034"), ("card", "4845 1681 1440 7329"), ("phone", "+44 20 7946 0958")]


def test_bare_mentions_and_name_forms():
    t = "Schmidt's day. Mrs Anna Schmidt came; later Schmidt left, ANNA stayed, Schmidt-Haus, anna@a.example.com"
    got = [(k, t[s:e]) for k, s, e, _ in pd_.entities(t)]
    assert got == [("surname", "Schmidt"), ("given_f", "Anna"), ("surname", "Schmidt"), ("surname", "Schmidt"), ("given_f", "ANNA"),
                   ("surname", "Schmidt"), ("email", "anna@a.example.com")]
    for t, want in (("Herr Prof. Dr. Müller", ["Müller"]), ("Dr. Ruth Bader Ginsburg", ["Ruth", "Bader", "Ginsburg"]),
                    ("Frau Ursula von der Leyen", ["Ursula", "Leyen"]), ("Mr J. R. O'Brien", ["O'Brien"]), ("Frau Anna", ["Anna"]),
                    ("MR PETER SMITH", ["PETER", "SMITH"]), ("Anna Maria Schmidt", ["Anna", "Maria", "Schmidt"]),
                    ("κυρία Μαρία Παππά", ["Μαρία", "Παππά"]), ("Miss The bus, the stop, the end of the line", ["The"])):
        assert [t[s:e] for _, s, e, _ in pd_.entities(t)] == want, t
    assert pd_.script_of(pd_.surrogate("surname", "παππά", 0, b"k")) == "greek"
    assert pd_.surrogate("given_x", "ruth", 0, b"k").title() in pd_.GIVEN["latin", "f"] + pd_.GIVEN["latin", "m"]


def test_full_formats_get_surrogates(spark, monkeypatch):
    ips = [".".join(p) for p in itertools.product("123456789", repeat=4)][:6000]  # of 6,561 values
    mails = [f"{c}@{h}.com" for c in "0123456789" for h in "0123456789"]  # all of one digit, all hosts of one digit
    ssns = ["078-05-1120"]
    rows = [("ip", x) for x in ips] + [("email", x) for x in mails] + [("ssn", x.replace("-", "")) for x in ssns]
    rounds = []
    write = pd_.write_table

    def counted(df, name="table"):
        rounds.append(name)
        assert len(rounds) < 30  # two tables a round
        return write(df, name)

    monkeypatch.setattr(pd_, "write_table", counted)
    got = pd_.resolve(spark.createDataFrame(rows, "kind string, core string"), b"k").collect()
    assert len(got) == len(rows) == len({r.core for r in got})
    new = {r.new for r in got}
    assert len(new) == len(rows) and not new & {c for _, c in rows}
    for r in got:
        if r.kind != "ssn":
            assert [e[0] for e in pd_.entities(pd_.written(r.kind, r.core, r.core, r.new))] == [r.kind]


def test_wide_surrogates_are_written_whole():
    for t in ("4845-1681-1440-7329", "+1 (017) 555-7713", "DE89 3704 0044 0532 0130 00", "a@b.example.com"):
        (kind, s, e, core), = pd_.entities(t)
        new = pd_.surrogate(kind, core, pd_.WIDE + 1, b"k")
        (kind2, s, e, core2), = pd_.entities(out := pd_.written(kind, t, core, new))
        assert (kind2, s, e, core2) == (kind, 0, len(out), new) and len(new) == len(core) + 2


def test_long_documents_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").filter("toxic is not null")
    model = tx.fit_on(docs, labels)
    long = docs.filter(F.char_length("text") > tx.SAMPLE_CHARS).join(F.broadcast(labels.select("doc_id", "toxic")), "doc_id")
    out = tx.toxicity(long.filter(tx.fold(F.col("doc_id")) == 2), model).select("score", "toxic").collect()
    clean, toxic = ([r.score >= tx.THRESHOLD for r in out if r.toxic == y] for y in (0, 1))
    print("long held out: flagged", sum(clean), "of", len(clean), "clean,", sum(toxic), "of", len(toxic), "toxic")
    assert len(clean) > 50 and sum(clean) / len(clean) < 0.02
    assert sum(toxic) / len(toxic) > 0.8


def test_fit_on_long_rows_alone(spark):
    plain = "a fine day and nothing else to say here\n" * 300
    docs = spark.createDataFrame([(i, ("you idiot fool\n" * (i % 2)) + plain, "en", "s", 1) for i in range(60)], DOC_SCHEMA)
    model = tx.fit_on(docs, spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int"))
    assert all((r.score >= tx.THRESHOLD) == r.doc_id % 2 for r in tx.toxicity(docs, model).collect())


def test_small_letters_are_no_names():
    for t in ("Anna łąka i Maria ślub", "Anna že to", "Mrs šle"):
        assert pd_.entities(t) == []
    assert [e[3] for e in pd_.entities("Anna Šimková, Mr Łukasz Żak")] == ["anna", "šimková", "łukasz", "żak"]


def test_names_of_all_kinds_and_hosts_are_distinct(spark):
    """1,200 words, each given name after Dr, Mrs or Mr or a surname, and all hosts of two letters."""
    kinds = ("given_x", "given_f", "given_m", "surname")
    rows = [(kinds[i % 4], f"{a}{b}{c}") for i, (a, b, c) in enumerate(itertools.product("bdfgklmnrs", "aeiou", "bdfgklmnrstvwyzhjcpqxžšč"))]
    hosts = [f"{a}{b}.com" for a in "abcdefghijklmnopqrstuvwxyz" for b in "abcdefghijklmnopqrstuvwxyz"]
    rows += [("host", h) for h in hosts] + [("email", f"me@{h}") for h in hosts] + [("surname", "nora"), ("given_f", "nora")]
    got = {(r.kind, r.core): (r.attempt, r.new) for r in pd_.resolve(spark.createDataFrame(rows, "kind string, core string"), b"k").collect()}
    assert len(got) == len(rows)
    names = [new for (kind, _), (_, new) in got.items() if kind in kinds]
    assert len(set(names)) == len(names) == 1202 and not set(names) & {c for k, c in rows if k in kinds}
    assert len({got["host", h][1] for h in hosts}) == len(hosts) and not {got["host", h][1] for h in hosts} & set(hosts)
    mails = {pd_.surrogate("email", f"me@{h}", got["email", f"me@{h}"][0], b"k", got["host", h][0]) for h in hosts}
    assert len(mails) == len(hosts)


def test_written_hosts_are_distinct(spark):
    hosts = [f"{a}{b}.org" for a in "abcdefghijklm" for b in "abcdefghij"]
    rows = [(i, f"to me@{h}, you@{h.upper()}", "en", "s", 1) for i, h in enumerate(hosts)]
    out = pd_.replace_private_data(spark.createDataFrame(rows, DOC_SCHEMA).repartition(3), "k").collect()
    new = {r["doc_id"]: re.findall(r"@(\S+\.org)", r["new_text"], re.I) for r in out}
    assert all(len(x) == 2 and x[0].lower() == x[1].lower() for x in new.values())
    assert len({x[0].lower() for x in new.values()}) == len(hosts) and not {x[0].lower() for x in new.values()} & set(hosts)
