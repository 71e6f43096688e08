"""Personal data against Python's own patterns, and the added spans of planted cases."""

import hashlib
import random
import re

import pytest

KINDS = ("email", "ip", "card", "phone")
PATTERNS = (
    re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    re.compile(r"[0-9]([\x20-]?[0-9])+"), re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def luhn(d):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def base(text):
    out = []
    for kind, pattern in enumerate(PATTERNS):
        for m in pattern.finditer(text or ""):
            d = re.sub("[^0-9]", "", m[0])
            if (True, kind == 1 and all(int(p) <= 255 for p in m[0].split(".")), 14 <= len(d) <= 19 and luhn(d), 10 <= len(d) <= 15)[kind]:
                out.append((m.start(), kind, m.end()))
    return sorted(out)


def listed(spans):
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def card(rng):
    d = "4" + "".join(rng.choices("0123456789", k=14))
    return next(d + c for c in "0123456789" if luhn(d + c))


def make(seed=11, n=300):
    rng = random.Random(seed)
    words = ["lorem", "über", "😀x", "is", "at", "the", "dot", "id", "a.b", "x@y", "v1.2", "é"]

    def thing():
        mail, phone = f"u{rng.randint(1, 999)}.a@mail{rng.randint(1, 9)}.example.com", f"+1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}"
        return rng.choice([
            mail, phone, card(rng), ".".join(str(rng.randint(0, 255)) for _ in range(4)), ".".join(str(rng.randint(0, 400)) for _ in range(rng.randint(3, 6))), card(rng)[:15] + "x",
            "".join(rng.choices("0123456789abcdef", k=40)), str(rng.randint(1, 99999)), "-".join(re.findall("....", card(rng))), "0" * rng.randint(1, 30), f"{mail}_{mail}", f"+{rng.randint(1, 99)}- .", "1.2.3.4.5.6.7.8",
            "%@a.b", "a@b@c.d.e", "@x.y", "+1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 7 8", "٣٤٥٦", "00255.1.1.001", "12-34 56", "1 -2",
        ])

    rows = [(i, rng.choice([" ", "  ", "\n", ", ", '="'] if rng.random() < 0.3 else [" "]).join(rng.choice(words) if rng.random() < 0.7 else thing() for _ in range(rng.choice([0, 1, 5, 40])))) for i in range(n)]
    rows += [(n, None), (n + 1, ""), (None, "u1.a@mail1.example.com"), (n + 2, "a" * 4_000), (n + 3, "1" * 9_000), (n + 4, "1 " * 5_000), (n + 5, "1." * 5_000), (n + 6, "+1" + " " * 9_000), (n + 7, "a.b@c.d " * 3000), (n + 8, "-@-.-")]
    return rows + [rows[7], rows[7]]


@pytest.fixture(scope="module")
def found(spark):
    from plyframe.llm.pii import find

    rng = random.Random(2)
    rows = make()
    merged = [(5000 + i, f"lorem +1 (415) 555-{1000 + i} {card(rng)} is the {card(rng)} {rng.randint(10, 99)}.1.2.3 é") for i in range(20)]
    merged += [(5500 + i, f"is {c} at") for i in range(12) for c in re.findall(r"4[0-9]{15}", merged[i][1])]  # some values stand alone elsewhere
    merged.append((6000, "the u7.a at mail1 dot example dot com is u7.a@mail1.example.com or u7.a (at) mail1 [dot] example (dot) com"))
    docs = spark.createDataFrame([(i, t, "s", 1, 2) for i, t in rows + merged], "doc_id long, text string, spans string, start int, c int").repartition(6)
    return rows, merged, find(docs).collect()


def test_base_spans_against_python(found):
    rows, merged, got = found
    want = sorted((str(i), *[sum(s[1] == k for s in base(t)) for k in range(4)], hashlib.sha256(listed(base(t)).encode()).hexdigest()) for i, t in rows + merged)
    assert sorted((str(r[0]), *r[1:6]) for r in got) == want


def test_base_spans_stay_and_all_are_in_order(found):
    rows, merged, got = found
    texts = {}
    for i, t in rows + merged:
        texts.setdefault(i, t or "")
    for r in got:
        spans = [(int(a), KINDS.index(k), int(b)) for k, a, b in (s.split(":") for s in r["spans"].split(",") if s)]
        assert spans == sorted(set(spans)) and set(base(texts[r["doc_id"]])) <= set(spans)
        assert all(0 <= a < b <= len(texts[r["doc_id"]]) for a, _, b in spans)


def test_spans_in_longer_runs_are_added(found):
    _, merged, got = found
    by = {r["doc_id"]: r["spans"].split(",") for r in got}
    for i, text in merged[:20]:
        phone = text.index("+1")
        cards = [m.start() for m in re.finditer(r"\b4[0-9]{15}\b", text)]
        assert f"phone:{phone}:{phone + 17}" in by[i] and all(f"card:{a}:{a + 16}" in by[i] for a in cards)


def test_trees_find_what_the_features_tell(spark):
    from pyspark.sql import functions as F

    from plyframe.llm import pii

    docs = spark.createDataFrame([(i, t) for i, t in make(seed=4, n=400)], "doc_id long, text string")
    candidates = pii.materialize(pii.candidates(docs).drop("text"), "pii-test")
    model = pii.train(candidates)
    rows = pii.examples(candidates).where("held").select("y", "n", (model.margin(F.col) >= 0).alias("hit")).collect()
    right = sum(r["n"] for r in rows if r["hit"] == (r["y"] == 1))
    most = max(sum(r["n"] for r in rows if r["y"] == y) for y in (0, 1))
    assert model.trees and right > most and right >= 0.9 * sum(r["n"] for r in rows)


def test_redaction(spark):
    from plyframe.llm import pii

    rows = [(1, "é u1@a.b, +1 (415) 555-1000 and 4111111111111111."), (2, None), (3, ""), (4, "nothing"), (5, "1.2.3.4"), (6, "x" + " 1.2.3.4" * 700)]
    got = dict(map(tuple, pii.redact(spark.createDataFrame(rows, "doc_id long, text string"), pii.Model(0.0, [], {})).collect()))
    assert got == {1: "é [EMAIL], [PHONE] and [CARD].", 2: None, 3: "", 4: "nothing", 5: "[IP]", 6: "x" + " [IP]" * 700}


def test_no_python_on_executors(spark):
    from plyframe.llm import pii

    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    rows = pii.selected(pii.candidates(docs), pii.Model(0.1, [{1: ("digits", 3), 2: 0.5, 3: -0.5}], {0: 0.0}))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|Exchange", plan)


@pytest.mark.parametrize("rows", [[], [(1, None), (2, "")], [(1, "no data here")], [(1, "a@b.c")]])
def test_small_tables(spark, rows):
    from plyframe.llm.pii import find

    got = find(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["spans"]) for r in got) == sorted((i, listed(base(t))) for i, t in rows)
