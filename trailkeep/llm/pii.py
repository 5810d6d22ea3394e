"""Personal data by boosted trees over candidate spans, DataFrame functions only.

Strict patterns give the base spans. Wider patterns propose more, possibly overlapping, spans: written-out addresses,
dotted cards, phones without a country code, IPv6, and secrets (long runs of mixed letters and digits). A gradient-boosted
classifier scores them by format and context, and those over their kind's threshold, calibrated on held-out candidates,
are added. It learns from evidence that its features do not see: a country code, a word like "token" before a run, a
check digit, a well-formed address. So a phone without a country code is taken if it looks like those that have one.
The trees are evaluated as column expressions, row by row, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailkeep.llm.common import staged

KINDS = ("email", "ip", "card", "phone")
_LOCAL = "[A-Za-z0-9._%+-]"
_EMAIL_START = rf"(?:\G|(?<!{_LOCAL}))"
# The base patterns, written so that a failing place is passed over once (possessive runs, and starts only where a run
# starts or the last match ended); they match what the plain forms match. Runs of 14 to 19 digits are cards.
BASE = {
    "email": rf"{_EMAIL_START}{_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){13,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Kinds of added spans, in the order of their numbers.
NAMES = (*KINDS, "secret")
_RUN = "[A-Za-z0-9+/_-]"
#: Wider patterns of the same kinds, and of secrets.
WIDE = {
    "email": rf"(?<!{_LOCAL}){_LOCAL}{{1,64}}+(?:@|\x20?[\(\[](?:at|AT)[\)\]]\x20?)[A-Za-z0-9-]{{1,63}}+(?:(?:\.|\x20?[\(\[](?:dot|DOT)[\)\]]\x20?)[A-Za-z0-9-]{{1,63}}+){{1,8}}+",
    "ip": r"(?<![0-9A-Fa-f:.])(?:[0-9A-Fa-f]{1,4}:){3,7}+[0-9A-Fa-f]{1,4}+(?![0-9A-Fa-f:])",
    "card": r"(?<![0-9])(?<![0-9][\x20.-])[0-9](?:[\x20.-]?[0-9]){12,18}+(?![\x20.-]?[0-9])",
    "phone": r"(?<![0-9A-Za-z+.-])(?:(?:\+|00)[0-9]{1,3}[\x20./-])?+\(?[0-9]{2,4}+\)?(?:[\x20./-]\(?[0-9]{2,4}+\)?){2,4}+(?![0-9])",
    "secret": rf"(?<![A-Za-z0-9+/_=.-])(?=[A-Za-z+/_-]*+[0-9])(?=[0-9+/_-]*+[A-Za-z]){_RUN}{{16,}}+={{0,2}}+(?![A-Za-z0-9@])",
}
#: The trees are fitted by one task for each so many different rows of features.
TASK_ROWS = 200_000
#: Of a kind's held-out candidates at or over its threshold at least this share must be right, and at least so many.
PRECISION, LEAST_RIGHT = 0.98, 5
TREES, DEPTH = 12, 3
_CUES = "(?i)phone|tel|call|fax|mobile|mail|contact|card|visa|account|address|host|server|\\bip\\b"
_ABROAD = r"^(?:\+|00)[0-9]{1,3}[\x20./-]"
_SECRET_CUE = r"(?i)(?:token|key|secret|passw(?:or)?d|pwd|bearer|credential|auth)[a-z_]*[\"']?\s*[:=]?\s*[\"']?$"
SPAN = "struct<start:int,end:int,what:string>"


def _spans(text: Column, pattern: str, hint: Column) -> Column:
    """``(start, end, what)`` of the matches from left to right, in code points; where ``hint`` fails there are none."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = F.zip_with(F.slice(F.split(text, pattern, -1), 1, F.size(found)), found, lambda gap, what: F.struct(F.length(gap).alias("gap"), what.alias("what")))
    zero = F.struct(F.lit(0).alias("at"), F.expr(f"CAST(array() AS array<{SPAN}>)").alias("out"))

    def step(state: Column, part: Column) -> Column:
        start = state["at"] + part["gap"]
        end = start + F.length(part["what"])
        return F.struct(end.alias("at"), F.array_append(state["out"], F.struct(start.alias("start"), end.alias("end"), part["what"].alias("what"))).alias("out"))

    return F.when(hint, F.aggregate(parts, zero, step, lambda s: s["out"])).otherwise(F.expr(f"CAST(array() AS array<{SPAN}>)"))


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether a digit string passes the Luhn check; each second digit from the right is doubled."""
    each = F.filter(F.split(F.reverse(digits), ""), lambda d: d != "")
    places = F.transform(each, lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
        d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(places, F.lit(0), lambda a, d: a + d) % 10 == 0


def _low_parts(text: Column) -> Column:
    """Whether all dotted numbers are at most 255."""
    return F.forall(F.split(text, "\\."), lambda p: F.regexp_replace(p, "^0+", "").rlike("^(?:[0-9]{0,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))


def _accepts(kind: str) -> Callable[[Column], Column]:
    return {
        "email": lambda s: F.lit(True),
        "ip": lambda s: _low_parts(s["what"]),
        "card": lambda s: _luhn(_digits(s["what"])),
        "phone": lambda s: F.length(_digits(s["what"])).between(10, 15),
    }[kind]


def _hints(text: Column) -> dict[str, Column]:
    digit = text.rlike("[0-9]")
    return {"email": text.contains("@"), "ip": text.contains(".") & digit, "card": digit, "phone": text.contains("+")}


def _tagged(spans: Column, kind: str) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(NAMES.index(kind)).alias("kind"), s["end"].alias("end"), s["what"].alias("what")))


def _with_base(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    hints = _hints(F.col("text"))
    return slim.withColumns({k: F.filter(_spans(F.col("text"), BASE[k], hints[k]), _accepts(k)) for k in KINDS})


def _by_kind(kind: Column, values: dict[str, Column], other: Column) -> Column:
    for name, value in values.items():
        other = F.when(kind == NAMES.index(name), value).otherwise(other)
    return other


def _with_candidates(based: DataFrame) -> DataFrame:
    """``base`` and ``more``: tagged base spans, and candidates with their features and the evidence for them."""
    text = F.col("text")
    hints = {"email": text.rlike("@|(?i)[\\(\\[]at[\\)\\]]"), "ip": text.rlike("[0-9A-Fa-f]:[0-9A-Fa-f]"), "card": text.rlike("[0-9]"),
             "phone": text.rlike("[0-9]"), "secret": text.rlike(WIDE["secret"])}
    base = F.concat(*[_tagged(F.col(k), k) for k in KINDS])
    wide = F.concat(*[_tagged(_spans(text, WIDE[k], hints[k]), k) for k in NAMES])
    both = based.withColumn("base", base).withColumn("wide", wide)
    number = lambda c: c.cast("double")
    left = lambda c, pattern: number(F.length(F.regexp_replace(c, pattern, "")))

    def read(s: Column) -> Column:
        """The value without what only its evidence may show: written-out signs, a country code."""
        plain = F.regexp_replace(F.regexp_replace(s["what"], r"(?i)\x20?[\(\[]at[\)\]]\x20?", "@"), r"(?i)\x20?[\(\[]dot[\)\]]\x20?", ".")
        value = _by_kind(s["kind"], {"email": plain, "phone": F.regexp_replace(s["what"], _ABROAD, "")}, s["what"])
        before = F.substring(text, F.greatest(s["start"] - 23, F.lit(1)), F.least(s["start"], F.lit(24)))
        return F.struct(
            s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), s["what"].alias("what"),
            value.alias("value"), before.alias("before"), F.substring(text, s["end"] + 1, F.lit(1)).alias("after"))

    def described(s: Column) -> Column:
        value, before, digits = s["value"], s["before"], _digits(s["what"])
        features = F.array(
            number(s["kind"]), number(F.length(value)), left(value, "[^0-9]"), left(value, "[^A-Za-z]"), left(value, "[^A-Z]"),
            left(value, "[0-9A-Za-z]"), left(value, "(?<=[0-9])[0-9]|[^0-9]"), number(F.length(F.regexp_extract(value, "[0-9]+", 0))),
            number(F.length(F.regexp_extract(value, "([0-9]+)[^0-9]*$", 1))), number(F.size(F.array_distinct(F.split(value, "")))),
            number(before.rlike("[\\p{L}\\p{N}]$")), number(s["after"].rlike("[\\p{L}\\p{N}]")), number(before.rlike("[\"'=:]\\s*$")),
            number(before.rlike(_CUES)),
        )
        long_enough = F.length(digits).between(9, 15)
        valid = _by_kind(s["kind"], {
            "email": value.rlike(rf"^{BASE['email'].removeprefix(_EMAIL_START)}$") & value.rlike(r"\.[A-Za-z]{2,}$"),
            "ip": left(value, "[^:]") == 7,
            "card": F.coalesce(_luhn(digits), F.lit(False)) & ~digits.rlike("^(.)\\1*$"),
            "phone": long_enough,
        }, F.lit(True))
        evident = _by_kind(s["kind"], {"phone": s["what"].rlike(_ABROAD), "secret": before.rlike(_SECRET_CUE)}, F.lit(True))
        apart = ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
        return F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), features.alias("features"),
                        valid.alias("valid"), (valid & evident).alias("right"), apart.alias("apart"))

    return both.withColumn("wide", F.transform("wide", read)).withColumn("more", F.transform("wide", described)).drop("wide")


class Scorer:
    """Boosted trees as nested conditions: the ``margin`` of a feature array, and each kind's margin to be taken (None: never)."""

    def __init__(self, trees: list[tuple[float, object]], thresholds: dict[str, float]):
        self.trees, self.thresholds = trees, thresholds

    def margin(self, features: Column) -> Column:
        def walk(node) -> Column:
            if isinstance(node, float):
                return F.lit(node)
            index, split, low, high = node
            return F.when(F.get(features, F.lit(index)) <= split, walk(low)).otherwise(walk(high))

        return reduce(lambda a, b: a + b, [F.lit(w) * walk(t) for w, t in self.trees])

    def takes(self, kind: Column, features: Column) -> Column:
        at_least = _by_kind(kind, {k: F.lit(t) for k, t in self.thresholds.items()}, F.lit(float("inf")))
        return F.round(self.margin(features), 3) >= at_least


def _tree(node) -> object:
    if node.subtreeDepth() == 0:
        return float(node.prediction())
    return node.split().featureIndex(), float(node.split().threshold()), _tree(node.leftChild()), _tree(node.rightChild())


def train(docs: DataFrame, task_rows: int = TASK_ROWS) -> Scorer | None:
    """The scorer learned from the candidates of all documents, about four in seven of them fitted and the rest held out.

    Equal rows of features are one weighted row, so what is fitted grows with the different rows only; they are spread by
    their features over as many tasks as ``task_rows`` asks. The parts are told apart by the text, so copies stay
    together. Nothing is learned (None) from documents without right or without wrong candidates; a kind with fewer
    than ``LEAST_RIGHT`` right ones held out gets no threshold and adds nothing.
    """
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import array_to_vector

    # The plain generator would add a filter on its array, which the optimizer pushes through the search for candidates.
    each = _with_candidates(_with_base(docs)).select((F.pmod(F.xxhash64("text"), F.lit(7)) < 3).alias("held"), F.explode_outer("more").alias("m"))
    rows = staged(each.where("m IS NOT NULL").groupBy("held", "m.features", F.col("m.right").cast("double").alias("label")).agg(F.count(F.lit(1)).cast("double").alias("n")))
    sizes = {(r.held, r.label): r["count"] for r in rows.groupBy("held", "label").count().collect()}
    if not all(sizes.get((False, label)) for label in (0.0, 1.0)):
        return None
    tasks = -(-sum(n for (held, _), n in sizes.items() if not held) // task_rows)
    shown = rows.where(~F.col("held")).drop("held")
    ordered = (shown.coalesce(1) if tasks == 1 else shown.repartition(tasks, "features")).sortWithinPartitions("features", "label")
    learner = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=9, maxBins=32, weightCol="n")
    java = learner.fit(ordered.select(array_to_vector("features").alias("features"), "label", "n"))._java_obj
    trees = [(float(w), _tree(t.rootNode())) for w, t in zip(java.treeWeights(), java.trees())]
    scorer = Scorer(trees, {})
    scored = rows.where("held").select(F.col("features")[0].cast("int").alias("kind"), F.round(scorer.margin(F.col("features")), 3).alias("m"), "label", "n")
    table = scored.groupBy("kind", "m").agg(F.sum(F.col("label") * F.col("n")).alias("right"), F.sum("n").alias("n")).collect()
    for kind, name in enumerate(NAMES):
        right = total = 0.0
        for r in sorted((r for r in table if r.kind == kind), key=lambda r: -r.m):
            right, total = right + r.right, total + r.n
            if right >= LEAST_RIGHT and right >= PRECISION * total:
                scorer.thresholds[name] = r.m
    return scorer if scorer.thresholds else None


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in NAMES])
    each = F.transform(F.array_sort(F.array_distinct(spans)), lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"]))
    return F.array_join(each, ",")


def find(docs: DataFrame, scorer: Scorer | None = None) -> DataFrame:
    """Columns ``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans`` for each row of ``docs(doc_id, text)``.

    Counts and digest are of the base spans; ``spans`` also has the well-formed candidates that the scorer takes and that
    overlap no base span, secrets among them (kind ``secret``, after the others). Null texts count as
    empty, without spans and with the digest of the empty text. Rows are read one by one: repeated rows and
    null ids stay as they are; other columns are ignored; an empty table gives an empty result.
    """
    rows = _with_candidates(_with_base(docs))
    place = lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))
    base = F.transform("base", place)
    spans = base
    if scorer is not None:
        taken = F.filter("more", lambda m: m["apart"] & m["valid"] & scorer.takes(m["kind"], m["features"]))
        spans = F.concat(base, F.transform(taken, place))
    return rows.select(
        "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"), _joined(spans).alias("spans"))
