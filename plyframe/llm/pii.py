"""Personal data in texts: candidate spans, gradient boosted trees over their format and context, calibrated thresholds.

Generators propose spans of four kinds that may overlap: every match of the base patterns, whether it passes its check or not; runs
of digits cut at their separators (cards in longer runs, phones with something behind them); e-mail addresses written with at and
dot; phones without a plus. A candidate is a row of small whole numbers: digits, groups, separators, first digit, what stands before
and behind, a cue word before it, length.

Labels come from the tables themselves: a base match is true or false by its check; a cut that fails the check, or lies in a true
match of its kind, is false; any other candidate is true if its value (digits, or the address) also stands somewhere as a base match,
else it has no label and doesn't train. Equal rows of features are counted before anything else, so the boosting works on a small
table whatever the input; its size is bounded by the values that features take. Trees are grown level by level from histograms of
whole-number gradients, one aggregation a level. A fifth of the documents (by doc_id) doesn't train: per kind the lowest score whose
candidates are true in PRECISION of the cases there is the threshold. A candidate that isn't a base span is selected if it passes its
check and reaches the threshold. The trees are then an expression over the candidates: everything is DataFrame operations, and a text
is read once.

Positions are code points from 0, ends exclusive. Defined cases: null and empty texts have no spans; documents without doc_id are
rows like others and train; repeated rows get equal results; a table without true or without false candidates adds nothing to the
base spans; a cue word counts within 24 code points, and not across an earlier match of the same pattern; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, only

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)
#: Matches are the same as without possessive quantifiers and look-behinds, which keep long runs from being tried again and again.
BASE = {
    EMAIL: r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    IP: r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    CARD: r"[0-9](?:[\x20-]?+[0-9])++",
    PHONE: r"\+[0-9][\x20().0-9-]+[0-9]",
}
AT, DOT = r"(?:@|\x20?[(\[][Aa][Tt][)\]]\x20?|\x20[Aa][Tt]\x20)", r"(?:\.|\x20?[(\[][Dd][Oo][Tt][)\]]\x20?|\x20[Dd][Oo][Tt]\x20)"
WRITTEN = rf"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++{AT}[A-Za-z0-9-]++(?:{DOT}[A-Za-z0-9-]++)++"
LOCAL = r"(?<![0-9A-Za-z+(.-])(?<!\+[0-9]{1,3}[\x20.-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9A-Za-z])"
CUES = {
    EMAIL: r"(?i)mail|contact|write",
    IP: r"(?i)\bip\b|address|host|server",
    CARD: r"(?i)card|visa|credit|pay|karte|tarjeta|carte",
    PHONE: r"(?i)phone|tel|call|fax|mobil|contact",
}
OTHER_CUE = r"(?i)token|key|secret|passw|sha|hash|version|order|ref|\bid\b"
FEATURES = ("digits", "groups", "separators", "lead", "before", "behind", "cue", "length")
#: Trees, their depth, the step, the weight that draws leaves to 0, and gradients' unit.
TREES, LEVELS, STEP, RIDGE, UNIT = 12, 3, 0.5, 1.0, 1_000_000
#: Share of true candidates on documents that didn't train, from the threshold on.
PRECISION = 0.95
HELD = 5


# --- candidates ----------------------------------------------------------------------------------------------------------


def _total(values: Column, low: Column, high: Column) -> Column:
    """The sum of values from low up to before high."""
    return F.when(high > low, F.aggregate(F.sequence(low, high - 1), F.lit(0).cast("long"), lambda a, j: a + F.get(values, j))).otherwise(F.lit(0).cast("long"))


def _blocks(values: Column) -> Column:
    """Sums of blocks of 256 values."""
    n = F.size(values)
    last = F.shiftright(F.greatest(n - 1, F.lit(0)), 8)
    return F.transform(F.sequence(F.lit(0), last), lambda b: _total(values, F.shiftleft(b, 8), F.least(n, F.shiftleft(b + 1, 8))))


def _before(values: Column, blocks: Column, i: Column) -> Column:
    """The sum of the values before the i-th, by whole blocks first."""
    b = F.shiftright(i, 8)
    return _total(blocks, F.lit(0), b) + _total(values, F.shiftleft(b, 8), i)


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _side(c: Column, near: Column) -> Column:
    """What stands next to a span: nothing, a letter, a digit, space (behind it a digit or not), a quote or sign, a joint, anything else."""
    return (
        F.when(c == "", 0).when(c.rlike(r"^\p{L}"), 1).when(c.rlike("^[0-9]"), 2).when(c.rlike(r"^\s") & near.rlike("^[0-9]"), 4).when(c.rlike(r"^\s"), 3)
        .when(c.rlike("^[\"'=:;,!?]"), 5).when(c.rlike("^[._+/-]"), 6).otherwise(7)
    )


def _check(kind: int, m: Column) -> Column:
    d = _digits(m)
    if kind == EMAIL:
        return F.lit(True)
    if kind == IP:
        return F.forall(F.split(m, r"\."), lambda p: p.rlike("^0*+(?:[0-9]{0,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    if kind == CARD:
        # the length first: longer runs aren't looked at
        return F.when(F.length(d).between(14, 19), F.call_function("luhn_check", d)).otherwise(F.lit(False))
    return F.length(d).between(10, 15)


def _candidate(kind: int, start: Column, m: Column, left: Column, right: Column, base: bool, check: Column, value: Column, false: Column | None = None) -> Column:
    """A span with its features. known: 1 true, 0 false, -1 without a label so far."""
    d = _digits(m)
    spaced, hyphened, other = m.contains(" "), m.contains("-"), m.rlike("[().]")
    lead = F.when(F.lit(kind == EMAIL), F.least(F.lit(15), F.length(F.regexp_extract(m, "^[^@ (\\[]+", 0)))).otherwise(F.coalesce(F.substring(d, 1, 1).cast("int"), F.lit(0)))
    last, near = F.right(left, F.lit(1)), F.substring(left, -2, 1)
    features = {
        "digits": F.least(F.lit(20), F.length(d)),
        "groups": F.least(F.lit(8), F.size(F.regexp_extract_all(m, F.lit("[0-9]++"), F.lit(0)))),
        "separators": spaced.cast("int") + 2 * hyphened.cast("int") + 4 * other.cast("int"),
        "lead": lead,
        "before": _side(last, near),
        "behind": _side(F.left(right, F.lit(1)), F.substring(right, 2, 1)),
        "cue": F.when(left.rlike(CUES[kind]), 2).when(left.rlike(OTHER_CUE), 0).otherwise(1),
        "length": F.least(F.lit(15), F.floor(F.length(m) / 2)),
    }
    known = check.cast("int") if base else F.when(~check | (F.lit(False) if false is None else false), 0).otherwise(-1)
    return F.struct(
        F.lit(kind).alias("kind"), start.cast("long").alias("start"), (start + F.length(m)).cast("long").alias("end"), (check if base else F.lit(False)).alias("base"),
        check.alias("checked"), known.cast("int").alias("known"), F.xxhash64(value).alias("value"), *[c.cast("int").alias(k) for k, c in features.items()],
    )


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id, text and c, the candidates of each text."""
    rows = only(docs, doc_id="long", text="string").withColumn("_t", F.coalesce("text", F.lit("")))
    patterns = {f"k{k}": p for k, p in BASE.items()} | {"written": WRITTEN, "local": LOCAL}
    rows = rows.select("doc_id", "text", *[x for g, p in patterns.items() for x in (F.regexp_extract_all("_t", F.lit(p), F.lit(0)).alias(f"m_{g}"), F.split("_t", p, -1).alias(f"s_{g}"))])
    taken = lambda s: lambda x, i: (F.length(x) + F.length(F.get(s, i))).cast("long")
    # code points that a match and the text before it take, and sums of blocks of them
    rows = rows.select("*", *[F.transform(f"m_{g}", taken(F.col(f"s_{g}"))).alias(f"l_{g}") for g in patterns])
    rows = rows.select("*", *[_blocks(F.col(f"l_{g}")).alias(f"b_{g}") for g in patterns])

    def spans(g: str) -> Column:
        m, s, n, b = (F.col(f"{x}_{g}") for x in "mslb")
        at = F.transform(
            m, lambda x, i: F.struct((_before(n, b, i) + F.length(F.get(s, i))).alias("start"), x.alias("m"), F.right(F.get(s, i), F.lit(24)).alias("left"), F.left(F.get(s, i + 1), F.lit(2)).alias("right"))
        )
        return F.when(F.size(b) > 0, at)  # b is used twice, so the planner doesn't compute it anew for each match

    rows = rows.select("doc_id", "text", *[spans(g).alias(g) for g in patterns])
    rows = rows.withColumn("runs", _runs(F.col("k2")))
    rows = rows.withColumn("runs", F.transform("runs", lambda r: r.withField("n", F.transform(r["groups"], lambda g: F.length(g).cast("long") + 1))))
    rows = rows.withColumn("runs", F.transform("runs", lambda r: r.withField("b", _blocks(r["n"]))))
    rows = rows.withColumn("cuts", F.flatten(F.transform("runs", _cuts)))
    value = {EMAIL: F.lower, IP: lambda m: m, CARD: _digits, PHONE: _digits}
    matched = lambda k: lambda c: _candidate(k, c["start"], c["m"], c["left"], c["right"], True, _check(k, c["m"]), value[k](c["m"]))
    held = [F.transform(f"k{k}", matched(k)) for k in range(4)]
    held.append(F.transform("cuts", lambda c: _candidate(CARD, c["start"], c["m"], c["left"], c["right"], False, _check(CARD, c["m"]), _digits(c["m"]), c["within"])))
    held += [_starts(F.col("k3"), n) for n in range(10, 16)]
    address = lambda m: F.lower(F.regexp_replace(F.regexp_replace(m, AT, "@"), DOT, "."))
    written = F.filter("written", lambda c: c["m"].rlike(r"[\x20(\[]"))
    held.append(F.transform(written, lambda c: _candidate(EMAIL, c["start"], c["m"], c["left"], c["right"], False, ~c["m"].rlike("[@.][A-Za-z0-9-]+$") & ~c["m"].contains("@"), address(c["m"]))))
    held.append(F.transform("local", lambda c: _candidate(PHONE, c["start"], c["m"], c["left"], c["right"], False, F.length(_digits(c["m"])) == 10, F.concat(F.lit("1"), _digits(c["m"])))))
    return rows.select("doc_id", "text", F.concat(*held).alias("c"))


def _starts(found: Column, n: int) -> Column:
    """The first n digits of each phone that has too many, if a group of digits ends there."""
    first = lambda c: F.regexp_extract(c["m"], rf"^\+(?:[^0-9]*+[0-9]){{{n}}}(?![0-9])", 0)
    longer = F.filter(found, lambda c: (F.length(c["m"]) > 16) & (first(c) != "") & (F.length(_digits(c["m"])) > 15))
    return F.transform(longer, lambda c: _candidate(PHONE, c["start"], first(c), c["left"], F.substr(c["m"], F.length(first(c)) + 1, F.lit(2)), False, F.lit(True), _digits(first(c))))


def _runs(found: Column) -> Column:
    """Runs of digits with separators that hold a card's digits and more: the run, its groups and what stands before each."""
    long = F.filter(found, lambda c: (F.length(c["m"]) > 14) & c["m"].rlike("[\\x20-]"))
    return F.transform(long, lambda c: F.struct(c.alias("r"), F.split(c["m"], "[\\x20-]", -1).alias("groups"), F.split(c["m"], "[0-9]++", -1).alias("joints"), _check(CARD, c["m"]).alias("within")))


def _cuts(run: Column) -> Column:
    """All stretches of whole groups with 14 to 19 digits, but the run itself. within: the run is a true match."""
    r, groups, joints, n, b = (run[x] for x in ("r", "groups", "joints", "n", "b"))
    last = F.size(groups) - 1
    pairs = F.transform(groups, lambda _, i: F.filter(F.transform(F.sequence(i, F.least(i + 18, last)), lambda j: F.struct(i.alias("i"), j.alias("j"))), lambda p: _total(n, p["i"], p["j"] + 1).between(p["j"] - p["i"] + 15, p["j"] - p["i"] + 20) & ~((p["i"] == 0) & (p["j"] == last))))
    text = lambda p: F.array_join(F.transform(F.sequence(p["i"], p["j"]), lambda q: F.concat(F.when(q > p["i"], F.get(joints, q)).otherwise(""), F.get(groups, q))), "")
    return F.transform(
        F.flatten(pairs),
        lambda p: F.struct(
            (r["start"] + _before(n, b, p["i"])).alias("start"), text(p).alias("m"),
            F.when(p["i"] == 0, r["left"]).otherwise(F.concat(F.right(F.get(groups, p["i"] - 1), F.lit(1)), F.lit(" "))).alias("left"),
            F.when(p["j"] == last, r["right"]).otherwise(F.concat(F.lit(" "), F.left(F.get(groups, p["j"] + 1), F.lit(1)))).alias("right"),
            run["within"].alias("within"),
        ),
    )


# --- boosting ------------------------------------------------------------------------------------------------------------


def examples(found: DataFrame) -> DataFrame:
    """kind, features, held (doesn't train), y and n: the labelled candidates, counted."""
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % HELD == 0, F.lit(False)).alias("held")
    rows = found.select(held, F.explode("c").alias("c")).select("held", "c.*")
    keys = ["kind", *FEATURES, "held"]
    # counted before the join, so that a value that stands everywhere is a few rows
    counted = rows.groupBy(*keys, "known", F.when(F.col("known") < 0, F.col("value")).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    counted = materialize(counted, "pii-counts")
    true = rows.where("base").select(F.col("kind").alias("_kind"), F.col("value").alias("_value")).distinct()
    open_ = counted.where("known < 0").join(true, (F.col("kind") == F.col("_kind")) & (F.col("value") == F.col("_value")), "left_semi").withColumn("known", F.lit(1))
    both = counted.where("known >= 0").unionByName(open_)
    return both.groupBy(*keys, F.col("known").alias("y")).agg(F.sum("n").alias("n"))


def _leaf(tree: dict, node: int, value) -> Column:
    """The tree below a node as an expression; value(feature) is the column of a feature, leaves are what `tree` holds for them."""
    if isinstance(tree[node], tuple):
        feature, cut = tree[node]
        return F.when(value(feature) <= cut, _leaf(tree, 2 * node, value)).otherwise(_leaf(tree, 2 * node + 1, value))
    return F.lit(tree[node])


def _grown(rows: DataFrame) -> dict:
    """A tree over rows with g (gradient) and h (weight), whole numbers: node -> (feature, cut) or a leaf's value. Children of n: 2n, 2n+1."""
    names = ("kind", *FEATURES)
    tree: dict = {1: 0.0}
    for level in range(LEVELS):
        at = _leaf({n: x if isinstance(x, tuple) else n for n, x in tree.items()}, 1, F.col)
        bins = F.explode(F.array(*[F.struct(F.lit(f).alias("f"), F.col(f).alias("b")) for f in names])).alias("s")
        counts = rows.select(at.alias("node"), "g", "h", bins).groupBy("node", "s.f", "s.b").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
        order = Window.partitionBy("node", "f")
        upto = counts.select("node", "f", "b", *[F.sum(x).over(order.orderBy("b")).alias(f"{x}l") for x in "gh"], *[F.sum(x).over(order).alias(x) for x in "gh"])
        score = lambda g, h: F.col(g).cast("double") * F.col(g) / (F.col(h) + RIDGE * UNIT) if isinstance(g, str) else g * g / (h + RIDGE * UNIT)
        gain = score("gl", "hl") + score((F.col("g") - F.col("gl")).cast("double"), F.col("h") - F.col("hl")) - score("g", "h")
        best = upto.select("node", "g", "h", F.struct(F.round(gain).alias("gain"), F.col("f"), (-F.col("b")).alias("b")).alias("s"), "gl", "hl")
        for r in sorted(best.groupBy("node").agg(F.max(F.struct("s", "g", "h", "gl", "hl")).alias("x")).collect()):  # a row a node
            node, x = r["node"], r["x"]
            if x["s"]["gain"] > 0:
                tree[node] = (x["s"]["f"], -x["s"]["b"])
                for child, g, h in ((2 * node, x["gl"], x["hl"]), (2 * node + 1, x["g"] - x["gl"], x["h"] - x["hl"])):
                    tree[child] = round(STEP * g / (h + RIDGE * UNIT), 4)
    return tree


class Model:
    """Trees over the features, and the margin from which a candidate of each kind is selected."""

    def __init__(self, start: float, trees: list[dict], cuts: dict[int, float]):
        self.start, self.trees, self.cuts = start, trees, cuts

    def margin(self, value) -> Column:
        """The sum of all trees; value(feature) is the column of a feature."""
        out = F.lit(self.start)
        for tree in self.trees:
            out = out + _leaf(tree, 1, value)
        return out

    def selects(self, c: Column) -> Column:
        cut = F.lit(math.inf)
        for kind, at in self.cuts.items():
            cut = F.when(c["kind"] == kind, at).otherwise(cut)
        return c["base"] | (c["checked"] & (self.margin(lambda f: c[f]) >= cut)) if self.cuts else c["base"]


def train(found: DataFrame) -> Model:
    """Boosted trees and thresholds from the candidates of all documents."""
    rows = materialize(examples(found), "pii-examples")
    sides = {r["y"]: r["n"] for r in rows.where("NOT held").groupBy("y").agg(F.sum("n").alias("n")).collect()}
    if len(sides) < 2:
        return Model(0.0, [], {})
    model = Model(round(math.log(sides[1] / sides[0]), 4), [], {})
    for _ in range(TREES):
        p = 1 / (1 + F.exp(-model.margin(F.col)))
        step = rows.where("NOT held").select("kind", *FEATURES, F.round(F.col("n") * (F.col("y") - p) * UNIT).cast("long").alias("g"), F.round(F.col("n") * p * (1 - p) * UNIT).cast("long").alias("h"))
        tree = _grown(step)
        if not isinstance(tree[1], tuple):
            break
        model.trees.append(tree)
    scored = rows.where("held").select("kind", F.round(model.margin(F.col), 3).alias("m"), "y", "n").groupBy("kind", "m").agg(F.sum("n").alias("n"), F.sum(F.col("y") * F.col("n")).alias("true"))
    down = Window.partitionBy("kind").orderBy(F.desc("m"))
    share = F.sum("true").over(down) / F.sum("n").over(down)
    cuts = {r["kind"]: r["m"] for r in scored.withColumn("share", share).where(F.col("share") >= PRECISION).groupBy("kind").agg(F.min("m").alias("m")).collect()}  # a row a kind
    # margins were rounded: a thousandth less keeps the candidates that gave the threshold; at least an even chance
    model.cuts = {k: max(0.0, cuts.get(k, 0.0) - 0.001) for k in range(4)}
    return model


# --- results -------------------------------------------------------------------------------------------------------------


def selected(found: DataFrame, model: Model) -> DataFrame:
    """found with base and all: arrays of (start, kind, end) in this order, without repeats."""
    flat = lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end"))
    spans = lambda keep: F.array_sort(F.array_distinct(F.transform(F.filter("c", keep), flat)))
    return found.select("*", spans(lambda c: c["base"]).alias("base"), spans(model.selects).alias("all"))


def _listed(spans: Column) -> Column:
    name = lambda k: F.element_at(F.array(*map(F.lit, KINDS)), k + 1)
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", name(s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and text with every selected span, where spans overlap their union, put as the kind of its first span in brackets."""
    rows = selected(candidates(docs), model).select("doc_id", "text", F.col("all").alias("s"))
    # how far the spans before each one reach: by blocks of 256, as for sums
    most = lambda a, low, high: F.when(high > low, F.aggregate(F.sequence(low, high - 1), F.lit(0).cast("long"), lambda x, j: F.greatest(x, a(j)))).otherwise(F.lit(0).cast("long"))
    end = lambda j: F.get(F.col("s"), j)["end"]
    n = F.size("s")
    rows = rows.withColumn("b", F.transform(F.sequence(F.lit(0), F.shiftright(F.greatest(n - 1, F.lit(0)), 8)), lambda b: most(end, F.shiftleft(b, 8), F.least(n, F.shiftleft(b + 1, 8)))))
    upto = lambda i: F.greatest(most(lambda j: F.get(F.col("b"), j), F.lit(0), F.shiftright(i, 8)), most(end, F.shiftleft(F.shiftright(i, 8), 8), i))
    rows = rows.withColumn("u", F.when(F.size("b") > 0, F.transform("s", lambda x, i: upto(i))))
    between = lambda a, b: F.substr("text", (a + 1).cast("int"), (b - a).cast("int"))
    name = lambda k: F.element_at(F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS]), k + 1)
    piece = F.transform("s", lambda x, i: F.when(x["start"] >= F.get("u", i), F.concat(between(F.get("u", i), x["start"]), name(x["kind"]))).otherwise(""))
    whole = F.length("text").cast("long")
    return rows.select("doc_id", F.when(n == 0, F.col("text")).otherwise(F.concat(F.array_join(piece, ""), between(F.array_max(F.transform("s", lambda x: x["end"])), whole))).alias("text"))


def find(docs: DataFrame) -> DataFrame:
    """One row per row of docs: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans."""
    found = materialize(candidates(docs).drop("text"), "pii-candidates")
    rows = selected(found, train(found))
    of = lambda k: lambda s: s["kind"] == k
    counts = [F.size(F.filter("base", of(k))).cast("long").alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return rows.select("doc_id", *counts, F.sha2(_listed(F.col("base")), 256).alias("base_sha256"), _listed(F.col("all")).alias("spans"))
