"""SimHash, line dedup, components, decontamination: against brute force."""

import random

import pytest
import xxhash
from pyspark.sql import functions as F

from daybook.llm import decontaminate, lines, simhash
from daybook.llm.components import components


def closure(n, linked):
    parent = list(range(n))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in range(n):
        for j in range(i):
            if linked(i, j):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return [root(i) for i in range(n)]


def test_components(spark):
    draw = random.Random(2)
    edges = [(draw.randrange(60), draw.randrange(60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(40)]
    edges += [(200, i) for i in range(201, 260)] + edges[:5]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    pairs = {(a, b) for a, b in edges} | {(b, a) for a, b in edges}
    want = closure(300, lambda i, j: (i, j) in pairs)
    assert got == {n: want[n] for a, b in edges if a != b for n in (a, b)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- SimHash ---


def plain_fingerprint(text, k=3):
    words = (text or "").translate({c: c + 32 for c in range(65, 91)}).split()
    grams = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprint():
    for text in (None, "", " \n", "One", "one TWO", "a b c", "É b c d " * 50, "x " * 9000 + "y"):
        assert simhash.fingerprint(text) % (1 << 64) == plain_fingerprint(text)


@pytest.mark.parametrize("max_bits, segments", [(3, 2), (3, 3), (2, 4), (4, 2), (0, 2)])
def test_links_span_the_components(spark, monkeypatch, max_bits, segments):
    monkeypatch.setattr(simhash, "BLOCK", 8)
    draw = random.Random(max_bits)
    fps = {draw.getrandbits(64) for _ in range(6)}
    for _ in range(90):
        x = draw.choice(sorted(fps))
        for _ in range(draw.randint(1, 4)):
            x ^= 1 << draw.randrange(64)
        fps.add(x)
    fps = sorted(fps)
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    links = simhash.fingerprint_links(spark.createDataFrame([(x,) for x in signed], "fp long"), max_bits, segments).collect()
    near = lambda i, j: (fps[i] ^ fps[j]).bit_count() <= max_bits
    place = {x: i for i, x in enumerate(signed)}
    got = {(place[r["a"]], place[r["b"]]) for r in links}
    assert closure(len(fps), lambda i, j: (i, j) in got or (j, i) in got) == closure(len(fps), near)


def test_near_duplicates_and_what_stays(spark):
    text = " ".join(f"w{i}" for i in range(400))
    rows = [(5, text, "a"), (3, text + " end", "b"), (9, None, "c"), (8, "", "d"), (7, "other words entirely", "e"),
            (7, "other words entirely", "e"), (None, " ", "f"), (4, text, "g")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    plain = [plain_fingerprint(r[1]) for r in rows]
    roots = closure(len(rows), lambda i, j: (plain[i] ^ plain[j]).bit_count() <= 3)
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        mine = [i for i, x in enumerate(rows) if x[0] == r["doc_id"]][0]
        ids = [rows[i][0] for i in range(len(rows)) if roots[i] == roots[mine] and rows[i][0] is not None]
        assert r["component_id"] == min(ids)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len(set(roots))
    assert simhash.near_duplicates(docs.limit(0)).count() == 0 == simhash.keep_one(docs.limit(0)).count()


# --- lines ---


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def changed(draw, text, edits):
    for _ in range(edits):
        i = draw.randrange(len(text) + 1)
        kind = draw.randrange(3)
        if kind == 0:
            text = text[:i] + draw.choice("abé") + text[i:]
        else:
            text = text[:i] + (draw.choice("abé") if kind == 1 else "") + text[i + 1 :]
    return text


def test_bit_parallel_distance(spark):
    draw = random.Random(3)
    pairs = [("", ""), ("", "a"), ("abc", "")]
    for _ in range(200):
        a = "".join(draw.choice("ab ") for _ in range(draw.randrange(10)))
        pairs.append((a, changed(draw, a, draw.randrange(5))))
    frame = spark.createDataFrame(pairs, "a string, b string")
    columns = [lines.within_edits(F.col("a"), F.col("b"), k).alias(f"k{k}") for k in (0, 1, 2, 3)]
    for (a, b), r in zip(pairs, frame.select(*columns).collect(), strict=True):
        assert [r[f"k{k}"] for k in (0, 1, 2, 3)] == [distance(a, b) <= k for k in (0, 1, 2, 3)]


@pytest.mark.parametrize("k", [1, 2])
def test_edit_links_are_all_links(spark, monkeypatch, k):
    monkeypatch.setattr(lines, "SMALL_GROUP", 4)
    monkeypatch.setattr(lines, "SHORT_REST", 16)
    draw = random.Random(k)
    texts = set()
    for _ in range(6):
        base = "".join(draw.choice("abcdefgh ") for _ in range(draw.randint(20, 50)))
        texts |= {changed(draw, base, draw.randrange(4)) for _ in range(12)}
    texts = sorted(texts)
    got = {(r["a"], r["b"]) for r in lines.edit_links(spark.createDataFrame(list(enumerate(texts)), "id long, line string"), k).collect()}
    want = {(i, j) for j in range(len(texts)) for i in range(j) if distance(texts[i], texts[j]) <= k}
    assert got <= want
    assert closure(len(texts), lambda i, j: (j, i) in got) == closure(len(texts), lambda i, j: (j, i) in want)


def test_many_lines_that_differ_in_one_place(spark):
    """600 lines that all lie within one edit of each other give links in proportion to the lines."""
    texts = [f"a line that says the same thing each time {chr(0x4E00 + i)}" for i in range(600)]
    frame = spark.createDataFrame(list(enumerate(texts)), "id long, line string")
    links = {(r["a"], r["b"]) for r in lines.edit_links(frame).collect()}
    assert len(links) <= 599 and set(closure(600, lambda i, j: (j, i) in links)) == {0}


def test_short_rests_with_gaps(spark):
    base = "a line that says the same thing each time "
    texts = sorted({base + e for e in ["", "a", "b", "ab", "ba", "bb", "abc", "x" * 3, "\x01a", "\x01b", "zz"]})
    frame = spark.createDataFrame(list(enumerate(texts)), "id long, line string")
    links = {(r["a"], r["b"]) for r in lines.edit_links(frame).collect()}
    near = lambda i, j: distance(texts[i], texts[j]) <= 1
    assert all(near(*link) for link in links)
    assert closure(len(texts), lambda i, j: (j, i) in links) == closure(len(texts), near)


@pytest.mark.parametrize("limit", [2_000_000, 0])
def test_repeated_lines_go(spark, monkeypatch, limit):
    monkeypatch.setattr(lines, "BROADCAST_ROWS", limit)
    a, b = "a line that is long enough to count", "another line, also long enough"
    rows = [
        (1, f"{a}\nshort\n{b}", "x"),
        (2, f"short\n{a}!\n{b}\n{b}", "x"),
        (3, f"{a}?", "x"),
        (None, b, "x"),
        (4, None, "x"),
        (5, "", "x"),
        (6, "short", "x"),
        (6, "short", "x"),
        (7, "shor\n \t\nshor\n\n \t", "x"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, copies_of string").withColumn("_lines", F.lit(9))
    got = {(r["doc_id"], r["text"]): (r["n_lines"], r["n_dropped"], r["copies_of"]) for r in lines.drop_repeated_lines(docs).collect()}
    assert got == {
        (1, f"{a}\nshort"): (3, 1, []),
        (2, ""): (4, 4, [1]),
        (3, ""): (1, 1, [1]),
        (None, b): (1, 0, []),
        (4, None): (1, 0, []),
        (5, ""): (1, 0, []),
        (6, ""): (1, 1, [1]),
        (7, "shor\n \t\n\n \t"): (5, 1, [7]),
    }
    assert lines.drop_repeated_lines(docs).select("_lines").distinct().collect() == [(9,)]
    assert lines.drop_repeated_lines(docs).count() == len(rows)
    assert lines.drop_repeated_lines(docs.limit(0)).count() == 0


def test_text_ids_of_documents(spark):
    docs = spark.createDataFrame([("a", "one line of some length"), ("b", "one line of some length"), ("c", "x")], "doc_id string, text string")
    got = {r["doc_id"]: (r["text"], r["copies_of"]) for r in lines.drop_repeated_lines(docs).collect()}
    assert got == {"a": ("one line of some length", []), "b": ("", ["a"]), "c": ("x", [])}


# --- decontamination ---


def grams(text):
    words = [w for w in "".join(c if c.isalnum() else " " for c in (text or "").lower()).split()]
    return {" ".join(words[i : i + 5]) for i in range(len(words) - 4)} or ({" ".join(words)} if words else set())


@pytest.mark.parametrize("limit", [2_000_000, 0])
def test_contaminated_by_brute_force(spark, monkeypatch, limit):
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", limit)
    draw = random.Random(8)
    words = [f"w{i}" for i in range(300)]
    text = lambda n: " ".join(draw.choice(words) for _ in range(n))
    items = [(i, text(draw.choice([1, 3, 5, 9, 20, 60]))) for i in range(25)] + [(90, None), (91, ""), (92, "Only Four, of them")]
    rows = [(i, text(draw.choice([0, 3, 40, 2000]))) for i in range(40)] + [(300, None), (301, "only four of them!"), (301, "only four of them!")]
    for i, item in enumerate(items[:25]):
        parts = item[1].upper().split()
        if i % 3 == 0 and len(parts) > 12:
            parts[draw.randrange(len(parts))] = "changed"
        rows.append((100 + i, f"{text(300)}. {',  '.join(parts)}\n{text(200)}"))
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, item_id int")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    want = set()
    for d, t in rows:
        have = grams(t)
        for i, x in items:
            need = grams(x)
            if need and len(need & have) >= 0.8 * len(need):
                want.add((d, i, len(need), len(need & have)))
    got = {(r["doc_id"], r["item_id"], r["n_shingles"], r["n_found"]) for r in decontaminate.contaminated(docs, benchmark).collect()}
    assert got == want and len(want) > 15
    clean = decontaminate.decontaminate(docs, benchmark)
    assert clean.columns == docs.columns
    assert sorted(r["doc_id"] for r in clean.collect()) == sorted(d for d, _ in rows if d not in {w[0] for w in want})
    assert decontaminate.decontaminate(docs, benchmark.limit(0)).count() == len(rows)
    assert decontaminate.decontaminate(docs.limit(0), benchmark).count() == 0


@pytest.mark.parametrize("common", [2, 16])
def test_a_template_makes_no_candidates(spark, monkeypatch, common):
    """Documents and items that share a passage, and nothing else, do not meet at all."""
    monkeypatch.setattr(decontaminate, "COMMON_ITEMS", common)
    draw = random.Random(2)
    text = lambda n: " ".join(f"w{draw.randrange(10**6)}" for _ in range(n))
    template = "which of the following is"
    items = [(i, f"{template} {text(draw.choice([4, 8, 30]))}") for i in range(60)]
    rows = [(i, f"{text(40)} {template} {text(40)}") for i in range(50)]
    rows += [(100 + i, f"{text(40)} {items[i][1]} {text(40)}") for i in range(0, 60, 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    keys = decontaminate._item_keys(benchmark, 0.8)
    shared = decontaminate.shingle_hashes(F.lit(template))
    assert keys.where(F.array_contains(shared, F.col("h"))).count() == 0
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(docs, benchmark).collect()}
    assert got == {(100 + i, i) for i in range(0, 60, 7)}
