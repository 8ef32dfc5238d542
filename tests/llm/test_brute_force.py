"""Operators against plain Python on whole small tables and on made cases."""

import itertools
import random
import re
from collections import Counter, defaultdict
from html.parser import HTMLParser

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tidewell.llm import decontaminate, exact_dedup, html_text, language_id, license_scan, packing, queries, simhash, suffix_dedup, toxicity, url_filter
from tidewell.llm.common import components, table

from .conftest import LONG, frame, prose

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def joined(n, links):
    up = list(range(n))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(FOLD))
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


# ---- op3

def test_simhash_query(spark, sf):
    docs = table(spark, sf, "documents").collect()
    got = {r["doc_id"]: r for r in queries.QUERIES["op3_simhash"](spark, sf).collect()}
    prints = [fingerprint(d["text"]) for d in docs]
    assert [got[d["doc_id"]]["fingerprint"] for d in docs] == [format(p, "016x") for p in prints]
    near = [(i, j) for i in range(len(docs)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4]
    order = sorted(range(len(docs)), key=lambda i: docs[i]["doc_id"])
    place = {i: k for k, i in enumerate(order)}
    root = joined(len(docs), [(place[i], place[j]) for i, j in near])
    assert {d["doc_id"]: got[d["doc_id"]]["component_id"] for d in docs} == {docs[i]["doc_id"]: docs[order[root[k]]]["doc_id"] for k, i in enumerate(order)}


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), min_size=1, max_size=5), st.lists(st.tuples(st.integers(0, 4), st.sets(st.integers(0, 63), max_size=6)), max_size=40), st.integers(0, 8))
def test_tree_finds_all_groups(seeds, changes, radius):
    codes = {*seeds} | {seeds[i % len(seeds)] ^ sum(1 << b for b in bits) for i, bits in changes}
    codes = np.array(sorted(codes), dtype=np.uint64)
    member, head = simhash.tree_links(codes, radius)
    root = np.arange(len(codes))
    pos = {int(c): i for i, c in enumerate(codes)}
    root[member] = head
    near = [(i, j) for i in range(len(codes)) for j in range(i) if int(codes[i] ^ codes[j]).bit_count() <= radius]
    assert root.tolist() == joined(len(codes), near) and len(pos) == len(codes)


@settings(max_examples=200, deadline=None)
@given(st.sets(st.integers(0, 63), max_size=4), st.integers(0, 2**64 - 1))
def test_blocks_meet(bits, code):
    other = code ^ sum(1 << b for b in bits)
    assert any(code & m == other & m for m in simhash.block_masks(4))


def test_shards_in_parts(spark, monkeypatch):
    monkeypatch.setattr(simhash, "SHARD", 5)
    base = 0x0123456789ABCDEF
    codes = sorted({base ^ (1 << a) ^ (1 << b) for a in range(20) for b in range(20)} | {base ^ 0x7FFF00000 << 8})
    df = spark.createDataFrame([(c - (1 << 64) if c >> 63 else c,) for c in codes], "fp long")
    roots = {r["node"]: r["root"] for r in components(simhash.links(df)).collect()}
    near = [(i, j) for i in range(len(codes)) for j in range(i) if (codes[i] ^ codes[j]).bit_count() <= 4]
    want = joined(len(codes), near)
    assert [roots.get(c, c) for c in codes] == [codes[i] for i in want]


def test_components_chain(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(7, 3), (3, 9)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(100, 141)}, 3: 3, 7: 3, 9: 3}


def test_one_of_near_copies_without_ids(spark):
    texts = [prose(20, 2000) + f" end{i}" for i in range(3)]
    prints = [fingerprint(t) for t in texts]
    assert all((p ^ q).bit_count() <= 4 for p in prints for q in prints)
    other = [prose(21, 300) + x for x in ("", " ")]
    kept = simhash.keep_one(frame(spark, [(None, t) for t in texts] + [(7, t) for t in other] + [(None, prose(22, 300))])).collect()
    assert sorted(str(r["doc_id"]) for r in kept) == ["7", "None", "None"] and len({r["text"] in texts for r in kept if r["doc_id"] is None}) == 2


# ---- op4

def spans_of(texts, size=50):
    words = {i: re.findall(r"[a-z0-9\x80-\U0010ffff]+", (t or "").translate(FOLD)) for i, t in texts}
    where = defaultdict(set)
    for i, w in words.items():
        for s in range(len(w) - size + 1):
            where[tuple(w[s : s + size])].add(i)
    out = set()
    for i, w in words.items():
        found = []
        for s in range(len(w) - size + 1):
            docs = where[tuple(w[s : s + size])]
            if len(docs) > 1:
                if found and found[-1][1] >= s:
                    found[-1] = (found[-1][0], s + size, min(found[-1][2], min(docs)))
                else:
                    found.append((s, s + size, min(docs)))
        out |= {(i, a, b - a, d) for a, b, d in found}
    return out


def test_suffix_query(spark, sf):
    docs = [(d["doc_id"], d["text"]) for d in table(spark, sf, "documents").collect()]
    assert {tuple(r) for r in queries.QUERIES["op4_suffix_dedup"](spark, sf).collect()} == spans_of(docs)


def test_suffix_made_passages(spark):
    p, q = prose(5, 55), prose(6, 49)
    rows = [(i, f"{prose(100 + i, 40)} {p} {prose(200 + i, i * 7)}") for i in range(6)] + [(20 + i, f"{prose(600 + i, 30)} {q} {prose(650 + i, 30)}") for i in range(4)]
    rows += [(40, p[: len(p) // 2]), (41, LONG), (42, LONG[1000:]), (43, prose(7, 50)), (44, prose(7, 50))]
    got = {tuple(r) for r in suffix_dedup.repeated_spans(frame(spark, rows)).collect()}
    assert got == spans_of(rows)
    assert {g[0] for g in got} >= {0, 1, 2, 3, 4, 5, 41, 42, 43, 44} and not {g[0] for g in got} & {20, 21, 22, 23, 40}


def test_copies_are_cut_once(spark, monkeypatch):
    """A text that a third of all rows have gives its suffixes once, and its spans to every row."""
    hot, other = prose(900, 120), prose(901, 60) + " " + " ".join(prose(900, 120).split()[20:80])
    texts = [hot] * 30 + [other] + [prose(910 + i, 100) for i in range(20)]
    cut = {}
    monkeypatch.setattr(suffix_dedup, "suffixes", lambda docs, passage, real=suffix_dedup.suffixes: cut.setdefault("rows", docs) and real(docs, passage))
    got = suffix_dedup.repeated_spans(frame(spark, enumerate(texts)).repartition(7)).collect()
    assert cut["rows"].count() == 22 and cut["rows"].select("doc").distinct().count() == 22
    assert sorted(tuple(r) for r in got) == sorted(spans_of(list(enumerate(texts))))


# ---- op6

def naive_best_fit(lengths, capacities, default):
    rooms = []
    for n in lengths:
        fit = [k for k, r in enumerate(rooms) if r >= n]
        if fit:
            k = min(fit, key=lambda k: rooms[k])
        else:
            k = len(rooms)
            rooms.append(max(default, min(c for c in capacities if c >= n)))
        rooms[k] -= n
    return sorted(rooms)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), min_size=1, max_size=80), st.sampled_from([8, 16, 64]))
def test_best_fit_is_best_fit(lengths, default):
    lengths = sorted(lengths, reverse=True)
    place, offset, contents = packing.best_fit(lengths, [8, 16, 64], default)
    opened = [max(default, min(c for c in (8, 16, 64) if c >= lengths[place.index(k)])) for k in range(len(contents))]
    assert sorted(o - c for o, c in zip(opened, contents)) == naive_best_fit(lengths, [8, 16, 64], default)  # whatever bin a tie takes
    assert [sum(n for n, k in zip(lengths, place) if k == b) for b in range(len(contents))] == contents


def check_packing(rows, capacities):
    bins = defaultdict(list)
    for r in rows:
        bins[r["bin_id"]].append(r)
    for own in bins.values():
        assert len({r["bin_capacity"] for r in own}) == 1
        end = 0
        for r in sorted(own, key=lambda r: r["bin_offset"]):
            assert r["bin_offset"] == end
            end += r["n_tokens"]
        assert own[0]["bin_capacity"] == min(c for c in capacities if c >= end)


def test_packing_query(spark, sf):
    rows = queries.QUERIES["op6_packing"](spark, sf).collect()
    check_packing(rows, packing.CAPACITIES)
    want = {d["doc_id"]: len(re.findall(r"[^ \t\n\r\f\v]+", d["text"] or "")) + 1 for d in table(spark, sf, "documents").collect()}
    got = defaultdict(int)
    for r in sorted(rows, key=lambda r: (r["doc_id"], r["piece"])):
        assert r["start"] == got[r["doc_id"]]
        got[r["doc_id"]] += r["n_tokens"]
    assert got == want


def test_packing_small_bins(spark, odd):
    rows = packing.pack(odd, (16, 64, 256), shard_rows=4).collect()
    check_packing(rows, (16, 64, 256))
    assert sum(r["n_tokens"] for r in rows) == sum(len(re.findall(r"[^ \t\n\r\f\v]+", d["text"] or "")) + 1 for d in odd.collect())


def test_joint_choice_is_the_cheapest():
    lengths = np.array(sorted(np.random.default_rng(0).integers(1, 700, 400), reverse=True))
    _, _, capacity = packing.pack_shard(lengths)
    place = packing.pack_shard(lengths)[0]
    total = sum(packing.cost(c) for c in dict(zip(place.tolist(), capacity.tolist())).values())
    for default in packing.CAPACITIES:
        contents = packing.best_fit(lengths.tolist(), packing.CAPACITIES, default)[2]
        assert total <= sum(packing.cost(min(c for c in packing.CAPACITIES if c >= n)) for n in contents) + 1e-6


# ---- op9

def plain(text):
    return " ".join(re.findall(r"[a-z0-9\x80-\U0010ffff]+", (text or "").lower()))


def test_decontaminate_query(spark, sf):
    got = {(r["doc_id"], r["item_id"]) for r in queries.QUERIES["op9_decontaminate"](spark, sf).collect()}
    items = [(r["item_id"], plain(r["text"])) for r in table(spark, sf, "benchmark").collect()]
    docs = [(r["doc_id"], f" {plain(r['text'])} ") for r in table(spark, sf, "documents").collect()]
    assert got == {(d, i) for d, text in docs for i, item in items if f" {item} " in text}


def test_templates(spark):
    bench = spark.createDataFrame([(1, "A farmer named Alice sells 12 boxes of apples at 3 dollars each and then walks 5 km back home with Alice's dog."), (2, None), (3, "x y"), (None, prose(3, 30))], "item_id long, text string")
    other = "Before. A farmer named Bob sells 40 boxes of apples at 7.5 euros each and then walks 9 miles back home with Bob's dog. After."
    mixed = other.replace("Bob's", "Carol's")
    rows = [(1, other), (2, mixed), (3, prose(8, 200)), (4, None), (5, prose(4, 50) + " " + prose(3, 30) + "\n" + prose(5, 50)), (6, "1 2 3 4 5 6 7 8 9 10 11 12 13 14 15 16")]
    got = {(r["doc_id"], r["item_id"], r["exact"]) for r in decontaminate.find_leaks(frame(spark, rows), bench, ["doc_id"]).collect()}
    assert got == {(1, 1, False), (5, None, True)}
    assert sorted(r["doc_id"] for r in decontaminate.drop_leaks(frame(spark, rows), bench).collect()) == [2, 3, 4, 6]
    assert decontaminate.drop_leaks(frame(spark, rows), bench.where("false")).count() == 6


def test_plain_copies(spark):
    """Word-for-word copies that template windows lose: a changed mention, slots mostly, no capitals; none where nothing is copied."""
    head, tail = prose(11, 25), prose(12, 25)
    sums = "12 15 27 30 57 4 53 sum 18 65 31 2 7 40"
    name = "yesterday Anna Berg met Carl Dorn near Emil Falk while Gina Holm saw Ivan Jung"
    bench = spark.createDataFrame([(1, f"{head} Alice {tail} Alice"), (2, sums), (3, name), (4, "7 8 9 10 11 12")], "item_id long, text string")
    rows = [(1, f"{head} Alice {tail} Carol"), (2, f"x {sums} y"), (3, f"{prose(13, 20)} {name.lower()}."), (4, prose(14, 200)), (5, sums.replace("7", "9").replace("5", "6").replace("3", "2")), (6, "a 7 8 9 10 11 12 b")]
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.find_leaks(frame(spark, rows), bench, ["doc_id"]).collect()}
    assert got == {(1, 1), (2, 2), (3, 3), (6, 4)}
    assert sorted(r["doc_id"] for r in decontaminate.drop_leaks(frame(spark, rows), bench).collect()) == [4, 5]


def canonical_words(text):
    """Plain words and template words, by regular expression."""
    words, shapes, end, number = [], [], 0, False
    for m in re.finditer(r"(?:[0-9A-Za-z\x80-\U0010ffff]|(?<=[0-9])[.,](?=[0-9]))+", text):
        w = m.group().translate(FOLD)
        opening = not words or re.search('[\n!".:?]', text[end : m.start()])
        name = re.match("[A-Z][a-z\x80-\U0010ffff]", m.group()) and not opening
        shape = "UNIT" if number and w in decontaminate.UNITS else "NUMBER" if re.fullmatch("[0-9.,]+", w) else "NAME" if name else w
        number, end = shape == "NUMBER", m.end()
        words.append(w)
        shapes.append(shape)
    return words, shapes


def plain_leaks(docs, items):
    """{(doc, item): (coverage, run)} by comparing every window of every document with every window of every item."""
    out = {}
    for (d, text), (b, item), template in itertools.product(docs, items, (False, True)):
        have, want = canonical_words(text), canonical_words(item)
        size = min(8, len(want[0]))
        if not size or template and size < 5 or size < 3 and len(have[0]) != size:
            continue
        slot = [x in ("NUMBER", "NAME", "UNIT") for x in want[1]]
        places = [i for i in range(len(want[0]) - size + 1) if not template or 2 * sum(slot[i : i + size]) <= size]
        shifts = defaultdict(set)
        for i, j in itertools.product(places, range(len(have[0]) - size + 1)):
            if want[template][i : i + size] == have[template][j : j + size]:
                shifts[j - i].add(i)
        covered, run = set(), 0
        for shift, at in shifts.items():
            pairs = {(want[0][k], have[0][k + shift]) for i in at for k in range(i, i + size) if template and slot[k]}
            if len({a for a, _ in pairs}) == len({c for _, c in pairs}) == len(pairs):
                covered |= at
                run = max(run, *(size - 1 + next(n for n in itertools.count() if i + n not in at) for i in at))
        if covered and (len(covered) / len(places) >= 0.5 or run >= 13):
            was = out.get((d, b), (0, 0))
            out[d, b] = (max(was[0], len(covered) / len(places)), max(was[1], run))
    return out


@pytest.mark.parametrize("few", [0, 2, 8])
def test_leaks_equal_brute_force(spark, few):
    """Whole and part copies, other names and numbers, contradictions, common preambles, items of common windows only, short items."""
    r = random.Random(few)
    preamble = "please read the text below and then answer the following question with care"
    items = []
    for i in range(14):
        body = [r.choice([prose(100 * i + j, 1), r.choice("Anna Berta Carla Dora Emil".split()), str(r.randint(2, 99)), "kg"]) for j in range(r.randint(4, 26))]
        opening = preamble.split()[: r.choice([0, 9, 10, 13])]
        items.append((i, " ".join(opening + body)))
    items += [(20 + i, preamble) for i in range(4)] + [(30, "who wrote War Peace"), (31, "why not"), (32, ""), (None, items[0][1]), (33, items[1][1])]
    docs = []
    for i in range(60):
        words = items[r.randrange(18)][1].split()
        a = r.randrange(len(words))
        part = words[a : a + r.randint(4, 30)] if i % 2 else words
        change = dict(zip("Anna Berta Carla Dora Emil".split(), r.sample("Greta Hanna Ida Jana Karla".split(), 5)))
        part = [change.get(w, w) if i % 3 else w for w in part]
        if i % 5 == 0:
            part[r.randrange(len(part))] = "Zora"
        docs.append((i, " ".join([prose(5000 + i, 6), preamble if i % 4 == 0 else "", *part, prose(6000 + i, 5)])))
    docs += [(100, "Tell me: who wrote war peace in one year?"), (101, "Why not?"), (102, "why not ask"), (103, ""), (104, "Who wrote 5 Peace")]
    bench = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, h string")
    got = {(x["doc_id"], x["item_id"]): (x["coverage"], x["run"]) for x in decontaminate.find_leaks(frame(spark, docs), bench, ["doc_id"], few=few).collect()}
    want = plain_leaks(docs, items)
    assert got == {k: (pytest.approx(c), n) for k, (c, n) in want.items()}
    assert {(100, 30), (101, 31), (0, 20)} <= set(got) and len(got) > 60


def test_preambles_pair_nothing(spark):
    """Documents and items with one preamble of ten words: no common window is an anchor, so nothing meets."""
    preamble = "read the following passage and answer the question below it"
    items = spark.createDataFrame([(i, f"{preamble} {prose(i, 20)}") for i in range(40)], "item_id long, text string")
    item, common = decontaminate.benchmark_windows(items, 8, 0.5, 13, 8)
    assert common.count() == 6 and item.where("not anchor").count() == 40 * 6
    docs = frame(spark, [(i, f"{preamble} {prose(1000 + i, 30)}") for i in range(50)] + [(60, f"{preamble} {prose(7, 20)}")])
    assert [(r["doc_id"], r["item_id"], r["coverage"]) for r in decontaminate.find_leaks(docs, items, ["doc_id"]).collect()] == [(60, 7, 1.0)]


# ---- op5, op7

def test_language_held_out(spark, sf):
    lang = {r["doc_id"]: r["lang"] for r in table(spark, sf, "documents").collect()}
    rows = [r for r in queries.QUERIES["op5_language_id"](spark, sf).collect() if r["held_out"] and r["lang_pred"] != "und"]
    assert np.mean([lang[r["doc_id"]] == r["lang_pred"] for r in rows]) > 0.97


def plain_chances(texts):
    """Chances of all 256 bytes after a context, by the definition of the method: a list for each context, shorter ones by recursion."""
    counts = defaultdict(Counter)
    for t in texts:
        data = b" " * language_id.ORDER + t.translate(FOLD).encode()
        for i in range(language_id.ORDER, len(data)):
            for k in range(language_id.ORDER + 1):
                counts[data[i - k : i]][data[i]] += 1

    def after(context):
        lower = after(context[1:]) if context else [1 / 256] * 256
        seen = counts.get(context, {})
        n = sum(seen.values())
        if n < language_id.LEAST:
            return lower
        left = sum(c for b, c in enumerate(lower) if b not in seen)
        return [seen[b] / (n + len(seen)) if b in seen else len(seen) / (n + len(seen)) * lower[b] / left for b in range(256)]

    return after


def test_language_code_lengths(spark):
    """Every tree against the definition, scripts of many bytes included."""
    texts = {"aa": ["Abracadabra abracadabra cadabra", "", "bra!"], "bb": ["мама мыла раму", "рама и мама"], "cc": ["日本語の本", "本の日本語と日本"]}
    rows = [(i, t, lang) for i, (lang, t) in enumerate((lang, t) for lang, group in texts.items() for t in group)]
    model = language_id.fit(frame(spark, rows))
    assert model.names == ("aa", "bb", "cc")
    asked = ["abra dabra", "мама", "", "本日 語x", "Z\x00~ÿ"]
    data = [t.encode() for t in asked]
    got = language_id.code_lengths(model, np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)]))
    for k, lang in enumerate(model.names):
        after = plain_chances(texts[lang])
        for i, t in enumerate(asked):
            padded = b" " * language_id.ORDER + t.translate(FOLD).encode()
            bits = -sum(np.log2(after(padded[j - language_id.ORDER : j])[padded[j]]) for j in range(language_id.ORDER, len(padded)))
            assert got[i, k] == pytest.approx(bits, rel=1e-4, abs=1e-3)


def test_language_codes_sum_to_one():
    text = np.frombuffer(b"abracadabra abracadabra cadabra", dtype=np.uint8)
    codes, n = np.unique(language_id.grams_of(text, np.array([0, len(text)])), return_counts=True)
    tree = language_id._tree(codes, n)
    for context in {int(c) >> 8 for c in codes} | {0x010203}:
        bits = language_id.gram_bits(tree, np.arange(256, dtype=np.uint32) + np.uint32(context << 8))
        assert np.exp2(-bits).sum() == pytest.approx(1, abs=1e-4)


def test_many_languages_and_minor_scripts(spark):
    """56 languages, each of its own words; two of them Cyrillic beside a Latin majority, a hot id that repeats."""
    cyrillic = "абвгдежзиклмнопрстуфхцчшщыэюя"

    def text(lang, seed, n=40):
        words, r = random.Random(lang), random.Random(f"{lang} {seed}")
        letters = cyrillic if lang >= 54 else "abcdefghijklmnopqrstuvwxyz"
        known = ["".join(words.choices(letters, k=words.randint(3, 8))) for _ in range(60)]
        return " ".join(r.choices(known, k=n))

    rows = [(100 * lang + i, text(lang, i), f"l{lang:02}") for lang in range(56) for i in range(12)]
    model = language_id.fit(frame(spark, rows + [rows[0]] * 400))
    assert len(model.names) == 56
    asked = [(lang, text(lang, 1000)) for lang in range(56)]
    got = {r["doc_id"]: r["lang_pred"] for r in language_id.predict(frame(spark, asked), model, ["doc_id"]).collect()}
    assert got == {lang: f"l{lang:02}" for lang in range(56)}


def test_toxicity_made(spark):
    bad = ["grublok", "snarvex", "plodmuk"]
    rows, marks = [], []
    for i in range(1200):
        words = prose(1000 + i, 60).split()
        toxic = i % 4 == 0
        if toxic:
            words[i % 50] = bad[i // 4 % 3]
        rows.append((i, " ".join(words)))
        marks.append((i, int(toxic)))
    labels = spark.createDataFrame(marks[:900] + [(None, 1), (5, None), (77777, 1)], "doc_id long, toxic int")
    docs = frame(spark, [*rows, (None, "x"), (2000, None), (2001, ""), (2002, "SNARVEX!")])
    model = toxicity.fit(docs, labels)
    got = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model, ["doc_id"]).collect()}
    assert all((got[i] >= 0.5) == bool(t) for i, t in marks)
    assert got[2000] == got[2001] < 0.5 <= got[2002] and all(0 <= s <= 1 for s in got.values())
    kept = toxicity.drop_toxic(docs, model)
    assert kept.columns == docs.columns and kept.count() == 1200 - 300 + 3
    nothing = toxicity.fit(docs, labels.where("toxic = 0"))
    assert toxicity.drop_toxic(docs, nothing).count() == docs.count() and {r["score"] for r in toxicity.score(docs, nothing, ["doc_id"]).collect()} == {0.0}


# ---- op8

def test_layout():
    page = """<title>no</title><p>One<p>two <b>three</b><ul><li>a<li>b<ol start=3><li>c<li>d</ol></ul>
    <table><tr><th>k<th>value<tr><td>long key<td>1</table><div hidden>x</div><span style="display: none">y</span><script>z</script>
    tail<br>end &amp; all<pre> keep
  this</pre>"""
    assert html_text.page_text(page).split("\n") == [
        "One", "", "two three", "", "- a", "- b", "  3. c", "  4. d", "", "k         value", "long key  1", "", "tail", "end & all", "", " keep", "  this",
    ]


def test_loose_parts_of_table_sections():
    def words(page):
        return html_text.page_text(page).split()

    assert words("<table><tbody><form><tr><td>x<td>y</tr></form></tbody></table>") == ["x", "y"]
    assert words("<table><tbody>text<tr><td>x</table>") == ["text", "x"]
    assert words("<table><tbody><div>text</div></table>") == ["text"]
    assert words("<table><form><tfoot><tr><td>a</tfoot></form><tr><td>b</table>") == ["a", "b"]
    assert words("<table><tbody><div>out<table><tr><td>in</table></div><tr><td>b</table>") == ["out", "in", "b"]
    assert words("<table><tbody hidden><tr><td>x</tbody><tbody><div hidden>y</div><tr><td>b</table>") == ["b"]
    assert words("<table><colgroup><col>stray</colgroup><tr><td>b</table>") == ["stray", "b"]


def test_text_of_controls_and_drawings():
    page = "a<textarea>b &amp; <i>c\n  d</textarea><select><option>e<option>f</select><svg><title>no</title><style>no</style><text>g</text><defs><text>no</text></defs></svg>h"
    assert html_text.page_text(page).split() == ["a", "b", "&", "<i>c", "d", "e", "f", "g", "h"]


def test_spans_of_cells():
    def lines(page):
        return html_text.page_text(page).split("\n")

    assert lines("<table><tr><td rowspan=2>a<td>b<td>c<tr><td>d<td>e<tr><td>f<td>g</table>") == ["a  b  c", "   d  e", "f  g"]
    assert lines("<table><tr><td>a<td rowspan=3>b<td>c<tr><td>d<td>e<tr><td>f<td rowspan=2>g<tr><td>h<td>i</table>") == ["a  b  c", "d     e", "f     g", "h  i"]
    assert lines("<table><tr><td colspan=2 rowspan=2>a<td>b<tr><td>c</table>") == ["a    b", "     c"]
    # a span ends with its section; 0 goes on to that end
    assert lines("<table><tbody><tr><td rowspan=0>a<td>b<tr><td>c<tr><td>d<tbody><tr><td>e<td>f</table>") == ["a  b", "   c", "   d", "e  f"]
    assert lines("<table><tr><td rowspan=9>a<td>b<tr><tr><td>c</table>") == ["a  b", "   c"]


def test_visibility_is_inherited():
    hidden, back = "style='visibility:hidden'", "style='visibility: visible'"

    def words(page):
        return html_text.page_text(page).split()

    assert words(f"a<div {hidden}>b<p {back}>c<i {hidden}>d</i></p>e</div>f") == ["a", "c", "f"]
    assert words(f"<table {hidden}><caption>x</caption><tr><td>a<td {back}>b<tr {back}><td>c</table>") == ["b", "c"]
    assert words(f"<table><tbody {hidden}>x<tr><td>a<tr {back}><td>b</table>") == ["b"]
    assert html_text.page_text(f"<ol><li>a<li {hidden}>b<li>c</ol>").split("\n") == ["1. a", "3. c"]
    assert words(f"<div style='display:none'><p {back}>x</div>y<p style='content-visibility:hidden'>z") == ["y"]


def test_controls_dialogs_and_old_elements():
    assert html_text.page_text("x<button>btn</button>y") == "x btn y"
    assert html_text.page_text("a<dialog>no</dialog><dialog open>yes</dialog>b").split() == ["a", "yes", "b"]
    assert html_text.page_text("a<noframes><p>no</noframes><noembed>no</noembed>b") == "ab"
    assert html_text.page_text("a<plaintext>b <b>c</b>\n</plaintext>  d").split("\n") == ["a", "", "b <b>c</b>", "</plaintext>  d"]


def test_pages_with_clashing_columns(spark):
    pages = spark.createDataFrame([(1, "<p>a", "x", 5, "y"), (2, None, "x", 6, None)], "page_id long, html string, text string, id int, url string")
    assert [tuple(r) for r in html_text.extract(pages).orderBy("page_id").collect()] == [(1, "a"), (2, "")]


class Plain(HTMLParser):
    def __init__(self):
        super().__init__()
        self.out, self.off = [], 0

    def handle_starttag(self, tag, attrs):
        self.off += tag in ("script", "style", "title", "head")

    def handle_endtag(self, tag):
        self.off -= tag in ("script", "style", "title", "head")

    def handle_data(self, data):
        if not self.off:
            self.out.append(data)


def test_html_query_keeps_all_visible_words(spark, sf):
    pages = {r["page_id"]: r["html"] for r in table(spark, sf, "pages").collect()}
    for r in queries.QUERIES["op8_html_text"](spark, sf).collect():
        p = Plain()
        p.feed(pages[r["page_id"]])
        got = [w for w in r["text"].split() if w != "-"]
        assert got == [w for w in "".join(x + " " for x in p.out).split() if w != "-"] or "".join(got) == "".join("".join(p.out).split()).replace("-", "")
        assert r["n_chars"] == len(r["text"])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("<p> <li> <ul> </ul> <table> <tr> <td> </td> </table> <ol> </p> </div> <div> <b> x y & < > <!-- <br> <pre> </pre> <h1 <td".split()), max_size=40))
def test_html_never_fails(parts):
    html_text.page_text(" ".join(parts))


def test_deep_page():
    assert html_text.page_text("<div><ul><li>" * 5000 + "end").endswith("end")


# ---- op10

def test_url_rules(spark):
    urls = ["http://a.example.org/es/x", "HTTPS://Example.ORG/en/12", "http://b.org", "http://b.org/", "http://x.com/fr/1?q#f", "http://notcom/de/", "http://com/de/", None, "nothing", "http://h?x=/fr/", "http://a.example.org.net/es/"]
    pages = spark.createDataFrame([(i, u, 1) for i, u in enumerate(urls)], "page_id long, url string, host int")
    labels = spark.createDataFrame([], "doc_id long, toxic int, quality int")
    got = [tuple(r) for r in url_filter.judge(pages, labels).orderBy("page_id").collect()]
    assert got == [
        (0, "a.example.org", "/es/x", "example.org/es/", "block"), (1, "example.org", "/en/12", "example.org/en/1", "block"), (2, "b.org", "", None, "allow"),
        (3, "b.org", "/", "org/", "allow"), (4, "x.com", "/fr/1", "com/fr/", "allow"), (5, "notcom", "/de/", None, "allow"), (6, "com", "/de/", "com/de/", "block"),
        (7, "", "", None, "allow"), (8, "", "", None, "allow"), (9, "h", "", None, "allow"), (10, "a.example.org.net", "/es/", None, "allow"),
    ]


def test_url_mining(spark):
    urls = [(i, f"http://{'spam' if i % 3 == 0 else 'good'}.site{i % 5}.net/{'pills' if i % 2 else 'news'}/{i}") for i in range(600)]
    labels = spark.createDataFrame([(i, int(i % 3 == 0 and i % 2 == 1), 1) for i in range(0, 500)] + [(None, 1, 1), (3, None, None)], "doc_id long, toxic int, quality int")
    pages = spark.createDataFrame([*urls, (None, None), (900, "http://spam.other.net/pills/1"), (901, "http://spam.other.net/news/2")], "page_id long, url string")
    got = {r["page_id"]: r["verdict"] for r in url_filter.judge(pages, labels).collect()}
    assert all((got[i] == "block") == (i % 6 == 3) for i, _ in urls) and got[900] == "block" and got[901] == "allow" and got[None] == "allow"


@pytest.mark.parametrize("seed", [1, 2])
def test_url_rules_equal_brute_force_mining(spark, seed):
    r = random.Random(seed)
    urls = [(i, "http://" + r.choice(["a", "b"]) + ".net/" + "/".join(r.choice(["p/pp", "q", "s", "t"]) for _ in range(3)) + "?" + r.choice(["k", "m"]) + "=1") for i in range(160)]
    bad = {i: ("http://a" in u) + ("/p/" in u) + ("k=" in u) + (r.random() < 0.3) >= 3 for i, u in urls}
    pages = spark.createDataFrame(urls, "page_id long, url string")
    labels = spark.createDataFrame([(i, int(b), 1) for i, b in bad.items()], "doc_id long, toxic int, quality int")
    link = F.col("page_id")
    sets = {x["url"]: set(x["t"]) for x in pages.select("url", url_filter.tokens(F.col("url")).alias("t")).collect()}
    base, rules = sum(bad.values()) / len(urls), []
    every = sorted(set().union(*sets.values()))
    for size in range(1, 6):
        for c in map(set, itertools.combinations(every, size)):
            hits = [bad[i] for i, u in urls if c <= sets[u]]
            if sum(hits) >= url_filter.LEAST and sum(hits) / len(hits) >= max(url_filter.CONFIDENCE, url_filter.LIFT * base):
                rules.append(c)
    want = {u for u in sets if any(c <= sets[u] for c in rules)}
    mined, items = url_filter.mine(url_filter.labelled(pages.withColumn("doc", link), labels, link))
    got = {x["url"] for x in url_filter.matched(pages.select("url").distinct(), mined, items).collect()}
    assert got == want and 0 < len(want) < len(sets)
    smallest = [c for c in rules if not any(d < c for d in rules)]
    token_of = {x["token"]: x["item"] for x in items.collect()}
    assert {frozenset(token_of[t] for t in c) for c in smallest} == {frozenset(x["wants"]) for x in mined.collect()}


def test_deep_paths_are_mined(spark):
    deep = lambda kind: "/".join(f"{kind}{k}" for k in range(20))
    urls = [(i, f"http://h{i % 2}.net/{deep('x' if i % 4 == 0 else 'y')}/{i}") for i in range(80)] + [(900, f"http://new.net/{deep('x')}"), (901, f"http://new.net/{deep('y')}")]
    labels = spark.createDataFrame([(i, int(i % 4 == 0), 1) for i in range(80)], "doc_id long, toxic int, quality int")
    got = {r["page_id"]: r["verdict"] for r in url_filter.judge(spark.createDataFrame(urls, "page_id long, url string"), labels).collect()}
    assert all((got[i] == "block") == (i % 4 == 0) for i in range(80)) and got[900] == "block" and got[901] == "allow"
    labels = spark.createDataFrame([(i, int(i % 4 == 0 and i < 80), 1) for i in range(120)], "doc_id long, toxic int, quality int")
    pages = spark.createDataFrame(urls[:80] + [(i, f"http://h0.net/{deep('x')}/{i}") for i in range(80, 120)], "page_id long, url string")
    assert {r["verdict"] for r in url_filter.judge(pages, labels).collect()} == {"allow"}  # a third of them bad: no rule is sure enough


# ---- op1

def test_license_blocks(spark):
    rows = [
        (1, "x\nReleased under the MIT License.\ny"), (2, "under released license the mit"), (3, "released under a license"), (4, prose(1, 500) + " licensed under CC BY-NC 4.0 " + prose(2, 500)),
        (5, "GNU General Public License, general public license mit license apache license"), (6, None), (7, "license"),
    ]
    got = {r["doc_id"]: r for r in license_scan.scan(frame(spark, rows)).collect()}
    assert got[1]["labels"] == "mit" and got[2]["labels"] == "mit" and got[2]["base_labels"] == "" and got[3]["labels"] == "" and got[4]["labels"] == "cc-by-nc-4.0"
    assert (got[5]["n_base"], got[5]["first_word"], got[5]["last_word"], got[5]["base_labels"]) == (4, 1, 9, "apache,gpl,mit")
    assert (got[6]["n_words"], got[6]["first_word"], got[6]["score"], got[7]["score"]) == (0, None, 0.0, 0.0)


def test_license_wrapped_over_lines(spark):
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files"
    bsd = "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided\nthat the following conditions are met:"
    far = prose(1, 700).replace(" ", "\n", 40)
    rows = [(1, mit), (2, bsd), (3, f"{far}\n# {bsd}\n{prose(2, 300)}"), (4, mit.split("\n")[0]), (5, "licensed\r\nunder\r\nCC BY-NC\r\n4.0"), (6, bsd.split("\n")[0] + "\n" + prose(3, 100) + "\n" + bsd.split("\n")[1])]
    got = {r["doc_id"]: (r["labels"], r["score"]) for r in license_scan.scan(frame(spark, rows)).collect()}
    assert got == {1: ("mit", 1.0), 2: ("bsd", 1.0), 3: ("bsd", 1.0), 4: ("", 0.0), 5: ("cc-by-nc-4.0", 1.0), 6: ("", 0.0)}


# ---- op2

def test_exact_ties(spark, odd, monkeypatch):
    def check(rows):
        sizes = Counter(d["text"] or "" for d in odd.collect())
        assert len(rows) == odd.count() and sorted(r["group_size"] for r in rows) == sorted(n for n in sizes.values() for _ in range(n))
        assert sum(r["kept"] for r in rows) == len(sizes)

    check(exact_dedup.mark_copies(odd).collect())
    assert exact_dedup.drop_copies(odd).count() == odd.select("text").fillna("").distinct().count()
    monkeypatch.setattr(exact_dedup, "MAX_WORDS", -1)  # the filter's words too many to broadcast
    check(exact_dedup.mark_copies(odd).collect())
    kept = exact_dedup.drop_copies(odd)
    assert kept.columns == odd.columns and sorted(r["text"] or "" for r in kept.collect()) == sorted({d["text"] or "" for d in odd.collect()})
    monkeypatch.setattr(exact_dedup, "filter_bits", lambda rows: 2)  # a filter that rules nothing out
    check(exact_dedup.mark_copies(odd).collect())
    monkeypatch.setattr(exact_dedup, "FOLDED_BITS", 2)  # nor the folded one
    assert exact_dedup.drop_copies(odd).count() == kept.count()


def test_no_text_is_shuffled_beyond_the_broadcast(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "MAX_WORDS", -1)
    docs = spark.createDataFrame([(i, f"text {i // 2 if i < 10 else i}") for i in range(40)], "doc_id long, text string")
    text = F.coalesce(F.col("text"), F.lit(""))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        seen = []
        words, bits, small = exact_dedup.text_filter(docs, text)
        assert not small
        for df in (exact_dedup.mark_digests(docs, "doc_id", text, words, bits), exact_dedup.mark_rows(docs, "doc_id", text, "maybe")):
            plan = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
            moved = re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*)\]", plan)
            assert not any(re.search(r"\btext#", columns) for columns in moved)
            seen.append(len(moved))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert seen[0] >= 2
    assert seen[1] == 0 and {r["doc_id"] for r in exact_dedup.mark_rows(docs, "doc_id", text, "maybe").where("maybe").collect()} >= set(range(10))
