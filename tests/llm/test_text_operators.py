"""Mixing, URL rules, personal data: small cases and brute force."""

import hashlib
import random
import re
from collections import Counter

import pytest
from hypothesis import given, settings as options
from hypothesis import strategies as st

from daybook.llm import mixing, pii, urls

DOCS = "doc_id long, text string, source string, size string, copy int"


def docs(spark, rows):
    return spark.createDataFrame([(*r, "theirs", 9) for r in rows], DOCS)


# --- mixing ---


def targets(sizes: dict) -> dict:
    """Water filling by rounds: what exceeds three times a source is shared again."""
    names = sorted([s for s in sizes if s is not None]) + [s for s in sizes if s is None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left, open_, found = sum(sizes.values()), set(names), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if 3 * sizes[s] < weight[s] * level}
        if not full:
            return found | {s: weight[s] * level for s in open_}
        found |= {s: 3.0 * sizes[s] for s in full}
        left -= sum(found[s] for s in full)
        open_ -= full
    return found


@pytest.mark.parametrize("seed", range(3))
def test_targets_by_rounds(spark, seed):
    draw = random.Random(seed)
    names = [None, "", "a", "b", "zoë", "c", "d"]
    rows = [(i, "w " * draw.choice([0, 1, 5, 40]), draw.choice(names)) for i in range(60)]
    plan = mixing.mix_plan(docs(spark, rows)).collect()
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len(text.split())
    want = targets(sizes)
    assert len(plan) == len(rows)
    for r in plan:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]])
        rate = r["target"] / r["source_size"] if r["source_size"] else 0
        assert rate // 1 <= r["copies"] <= -(-rate // 1) <= 3


@pytest.mark.parametrize("limit", [100_000, 0])
def test_mix_emits_the_planned_copies(spark, monkeypatch, limit):
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", limit)
    rows = [(i % 50, f"some words {i % 50}", ["a", "b", None][i % 3]) for i in range(150)] + [(None, None, "b")]
    frame = docs(spark, rows)
    planned = sum(r["copies"] for r in mixing.mix_plan(frame).collect())
    mixed = mixing.mix(frame)
    assert mixed.columns == ["doc_id", "text", "source", "size", "copy"]
    assert mixed.count() == planned == mixing.mix(frame).count()
    assert {r["size"] for r in mixed.collect()} == {"theirs"}


def test_mix_of_nothing(spark):
    assert mixing.mix(docs(spark, [])).count() == 0
    assert mixing.mix(docs(spark, [(1, None, None), (2, " \t", "a")])).count() == 0


# --- URL rules ---


def judged(host, path, rules):
    best = None
    for h, p, verdict in rules:
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            key = (len(h + p), h.count("."), h + p, verdict)
            best = max(best or key, key)
    return (best[2], best[3]) if best else (None, "allow")


def test_urls_by_brute_force(spark):
    draw = random.Random(5)
    labels, parts = ["a", "b-c", "org", "com"], ["", "/", "/x", "/x/", "/x/y", "/é"]
    host = lambda: ".".join(draw.choice(labels) for _ in range(draw.randint(1, 4)))
    rules = list({(host(), draw.choice(parts)): draw.choice(["allow", "block"]) for _ in range(40)}.items())
    rules = [(h, p, v) for (h, p), v in rules]
    found = [(host(), draw.choice(parts) + draw.choice(["", "z", "/y"])) for _ in range(300)]
    pages = spark.createDataFrame(
        [(i, f"HTTP://{h.upper()}{p if p[:1] in ('', '/') else '/' + p}?q#f", "mine") for i, (h, p) in enumerate(found)],
        "page_id long, url string, rule string",
    )
    for r in urls.judge(pages, urls.rules_frame(spark, rules)).collect():
        assert r["host"] == r["host"].lower()
        assert (r["rule"], r["verdict"]) == judged(r["host"], r["path"], rules), (r, rules)


def test_url_edge_cases(spark):
    long_ = "http://x.org/" + "y" * 100_000
    cases = [None, "", "no scheme", "http://", "http://ORG", "http://org/", "http://www.org/?a://b", long_, long_]
    pages = spark.createDataFrame([(i // 2, u) for i, u in enumerate(cases)], "page_id long, url string")
    got = urls.judge(pages, urls.rules_frame(spark)).collect()
    assert Counter((r["url"], r["host"], r["rule"], r["verdict"]) for r in got) == Counter(
        [(None, "", None, "allow"), ("", "", None, "allow"), ("no scheme", "", None, "allow"), ("http://", "", None, "allow"),
         ("http://ORG", "org", None, "allow"), ("http://org/", "org", "org/", "allow"),
         ("http://www.org/?a://b", "www.org", "org/", "allow"), *[(long_, "x.org", "org/", "allow")] * 2]
    )
    none = urls.rules_frame(spark).limit(0)
    assert {r["verdict"] for r in urls.judge(pages, none, default="block").collect()} == {"block"}
    assert urls.judge(pages.limit(0), urls.rules_frame(spark)).count() == 0


# --- personal data ---

BASE = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def base_spans(text):
    found = []
    for kind, pattern in BASE.items():
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m.group())
            keep = {
                "email": True,
                "ip": all(int(p) <= 255 for p in m.group().split(".")) if kind == "ip" else True,
                "card": 12 <= len(digits) <= 19 and luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if keep:
                found.append((kind, m.start(), m.end()))
    return sorted(found, key=lambda s: (s[1], list(BASE).index(s[0])))


@options(max_examples=300, deadline=None)
@given(st.text(alphabet="a.@-+ 0123456789()é%", max_size=60))
def test_base_spans_are_the_patterns(text):
    got = [s for s in pii.find_spans(text) if s[0] in pii.BASE_KINDS]
    assert got == base_spans(text)


@options(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from(["4", "0", "5500 0000 0000 0004", "4111-1111-1111-1111", " ", ".", "+1", "255", "256", "a@b.c", "@"]), max_size=12))
def test_base_spans_of_likely_parts(parts):
    text = "".join(parts)
    assert [s for s in pii.find_spans(text) if s[0] in pii.BASE_KINDS] == base_spans(text)


def test_added_spans():
    text = 'token = "abcdef123456" IBAN GB82 WEST 1234 5698 7654 32, SSN: 123-45-6789; jo [at] mail [dot] org ftp://me:pw@host.org acct no. 12345678'
    kinds = [s[0] for s in pii.find_spans(text)]
    assert {"secret", "iban", "ssn", "masked_email", "login", "account"} <= set(kinds)


def test_long_runs_take_linear_time():
    for text in ("1" * 200_000, "1." * 100_000, "a@" * 100_000, "+1" * 100_000, "a" * 200_000 + "@", "1 " * 100_000):
        pii.find_spans(text)


def test_personal_data_columns(spark):
    rows = [(1, "a@b.org 10.0.0.1", "x"), (1, None, "y"), (2, "", None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    got = pii.personal_data(frame).collect()
    assert [(r["n_email"], r["n_ip"], r["base"]) for r in got] == [(1, 1, "email:0:7,ip:8:16"), (0, 0, ""), (0, 0, "")]
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0")
    assert pii.personal_data(frame.limit(0)).count() == 0
