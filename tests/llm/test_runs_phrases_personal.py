"""Periodic runs, phrase collocations and personal data against plain Python."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tidewell.llm import collocations, periodic_runs, personal_data, queries
from tidewell.llm.common import table

from .conftest import frame

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ---- op11


def plain_runs(words):
    """All maximal stretches at each lag; of one stretch the smallest lag."""
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q - i), q)
            i = max(i + 1, j)
    return sorted((s, q, n) for (s, n), q in found.items())


def plain_digest(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = plain_runs(words)
    gone = {i for s, q, n in runs for i in range(s + q, s + n)}
    best = (None,) * 4
    for s, q, n in runs:
        if best[0] is None or n * best[2] > best[1] * q:
            best = (s, n, q, 1000 * n // q)
    return len(runs), *best, sha("".join(f"{s},{n},{q}\n" for s, q, n in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone))


def test_runs_query(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text").collect()
    got = {r[0]: tuple(r)[1:] for r in queries.QUERIES["op11_periodic_runs"](spark, sf).collect()}
    short = [d for d in docs if len(d["text"]) < 12_000]
    assert len(got) == len(docs) and len(short) > 150
    assert {d["doc_id"]: got[d["doc_id"]] for d in short} == {d["doc_id"]: plain_digest(d["doc_id"], d["text"]) for d in short}
    assert sum(n for n, *_ in got.values()) > 0


def made_words(seed):
    r = random.Random(seed)
    kinds, words = r.choice([1, 2, 3, 5, 50]), []
    for _ in range(r.randint(0, 6)):
        period = r.choice([1, 2, 3, 5, 7, 8, 9, 10, 15, 16, 17, 20, 31, 33, 40, 64, 65])
        block = [r.randrange(kinds) for _ in range(period)]
        if r.random() < 0.3:
            block = block[: max(1, period // 3)] * r.randint(2, 6) + block
        length = int(len(block) * r.choice([0.5, 2, 3.9, 4, 4.1, 5, 7])) + r.randint(-1, 1)
        words += [block[i % len(block)] for i in range(length)]
    return words


@settings(max_examples=400, deadline=None)
@given(st.integers(0, 10**9))
def test_runs_of_made_words(seed):
    words = made_words(seed)
    found = periodic_runs.find_runs(np.array(words, dtype=np.int64), len(words))
    assert [(s, q, n) for s, n, q in found.tolist()] == plain_runs(words)


def test_long_periods_and_neighbouring_documents(spark):
    r = random.Random(4)
    block = [f"w{r.randrange(10**6)}" for _ in range(5_000)]
    rows = [(1, " ".join(block * 4)), (2, " ".join((block * 4)[:-1])), (3, "a a a a a"), (4, "a a a a a a"), (5, "é x \té x\né x é x é x é x"), (6, "x a b a b a b a b a b c"), (None, None), (7, "")]
    got = {r["doc_id"]: r for r in periodic_runs.collapse_runs(frame(spark, rows), ["doc_id"]).collect()}
    runs = {k: [tuple(x) for x in r["runs"]] for k, r in got.items()}
    assert runs == {1: [(0, 20_000, 5_000)], 2: [], 3: [], 4: [(0, 6, 1)], 5: [(0, 6, 1)], 6: [(1, 10, 2)], None: [], 7: []}
    assert got[1]["collapsed"] == " ".join(block) and got[6]["collapsed"] == "x a b c" and got[3]["collapsed"] == "a a a a a" and got[None]["collapsed"] == ""
    assert got[5]["n_words"] == 6 and got[5]["collapsed"] == "é x"


# ---- op12


def plain_collocations(rows, least, top):
    count, total = Counter(), Counter()
    for text, lang in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(FOLD)):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for i in range(len(words)):
                count.update((lang, tuple(words[i : i + k])) for k in range(1, min(5, len(words) - i) + 1))
    kept = {key: f for key, f in count.items() if len(key[1]) > 1 and f >= least}
    out = {}
    for (lang, words), a in kept.items():
        inside = any(
            l2 == lang and len(w2) > len(words) and 100 * f2 >= 100 * a and any(w2[i : i + len(words)] == words for i in range(len(w2)))
            for (l2, w2), f2 in kept.items()
        )
        if not inside:
            cuts = [(1000 * a * total[lang] // (count[lang, words[:k]] * count[lang, words[k:]]), k) for k in range(1, len(words))]
            score, k = min(cuts)
            out.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), count[lang, words[:k]], count[lang, words[k:]]))
    return sorted((lang, i, p.decode(), -a, l, r, total[lang], -s) for lang, found in out.items() for i, (s, a, p, l, r) in enumerate(sorted(found)[:top], 1))


@pytest.mark.parametrize("top", [2000, 3])
def test_collocations(spark, top):
    r = random.Random(8)
    words = ["a", "b", "c", "É", "É", "Dd", "日本", "x y"]
    rows = [(i, "".join(r.choice(words) + r.choice([" ", " ", " ", " \t ", ". ", "\n", "?", "  "]) for _ in range(r.randrange(120))), r.choice(["en", "de", None, "und"])) for i in range(60)]
    rows += [(None, None, "en"), (1, "", None), (2, ". , \n", "en"), (3, "one", "rare")] + [(9, "a b c dd a", "en")] * 4
    got = collocations.collocations(frame(spark, rows), least=4, top=top)
    assert sorted(map(tuple, got.collect())) == plain_collocations([x[1:] for x in rows], 4, top)
    assert collocations.collocations(frame(spark, rows).where("false"), least=4).count() == 0


def test_full_counters_change_nothing(spark, monkeypatch):
    """All pairs share few counters, so no window is cut."""
    rows = [(i, "p q r s t u " * 3, "en") for i in range(5)]
    want = [tuple(r) for r in collocations.collocations(frame(spark, rows), least=5).collect()]
    monkeypatch.setattr(collocations, "slots_for", lambda n: 64)
    assert [tuple(r) for r in collocations.collocations(frame(spark, rows), least=5).collect()] == want and want


def test_scores_beyond_64_bits(spark):
    a, n, l, r = 9_000_000_000_000, 9_999_999_999_999_999, 9_100_000_000_001, 9_000_000_000_007
    row = spark.createDataFrame([(a, n, l, r)], "a long, n long, l long, r long")
    assert row.select(collocations.exact_score("a", "n", "l", "r").alias("s")).first()["s"] == 1000 * a * n // (l * r)


# ---- op13


def plain_spans(text):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m[0] if c not in " -"]
        odd, even = digits[-1::-2], [sum(divmod(2 * d, 10)) for d in digits[-2::-2]]
        if 12 <= len(digits) <= 19 and (sum(odd) + sum(even)) % 10 == 0:
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def named(spans):
    return ",".join(f"{personal_data.KINDS[k]}:{a}:{b}" for a, k, b in spans)


def test_personal_data_query(spark, sf):
    docs = {d["doc_id"]: d["text"] or "" for d in table(spark, sf, "documents").collect()}
    rows = queries.QUERIES["op13_personal_data"](spark, sf).collect()
    assert len(rows) == len(docs)
    for r in rows:
        want = plain_spans(docs[r["doc_id"]])
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == [sum(k == i for _, k, _ in want) for i in range(4)]
        assert r["base_sha256"] == sha(named(want)) and set(filter(None, named(want).split(","))) <= set(r["spans"].split(","))
    assert sum(r["n_email"] for r in rows) and sum(r["n_card"] for r in rows)


BITS = ["@", ".", "+", "-", " ", "1", "23", "255", "256", "0255", "4111111111111111", "4929 1234", "a", "bc", "é", "٣", "(", ")", "%", "_", "0", "x@y.z", "1.2.3.4", "+1 (988) 555-2485", "\n", "iban", "日", "://"]


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.sampled_from(BITS), max_size=30))
def test_base_kinds(parts):
    text = "".join(parts)
    assert [s for s in personal_data.find_spans(text) if s[1] < 4] == plain_spans(text)


@pytest.mark.parametrize(
    "text, want",
    [
        ("see https://bob:s3cret@host.org/x", [("login", "bob:s3cret"), ("email", "s3cret@host.org")]),
        ("https://host.org/a:b@c and ftp://bob@h", []),
        ("IBAN: DE89 3704 0044 0532 0130 00 ok", [("iban", "DE89 3704 0044 0532 0130 00")]),
        ("iban GB82WEST12345698765433", []),
        ("Account number 12345-678 x, accountant 1234567, account 123", [("account", "12345-678")]),
        ("SSN 123-45-6789.", [("account", "123-45-6789")]),
        ("9" * 5000 + ".1.1.1", []),
    ],
)
def test_announced_kinds(text, want):
    assert [(personal_data.KINDS[k], text[a:b]) for a, k, b in personal_data.find_spans(text)] == want


@pytest.mark.parametrize("unit", ["1", "a@", "1 ", "+1 ", "iban ", "account - ", "1.", "://", "x:", "a.", "iban AA11"])
def test_long_odd_texts_take_linear_time(unit):
    personal_data.find_spans(unit * 200_000)


# ---- odd rows


def test_odd_rows(odd, none):
    for run, label in ((periodic_runs.collapse_runs, "runs"), (personal_data.find_personal_data, "spans")):
        assert run(none, ["doc_id"]).count() == 0
        rows = run(odd, ["doc_id", "W__"]).collect()
        assert len(rows) == odd.count() and all(r[label] is not None for r in rows)
    assert collocations.collocations(odd, least=2).select(F.max("rank")).first()[0] > 0
