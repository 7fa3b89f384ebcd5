"""Personal data: generators propose spans, boosted trees select among them.

DataFrame and SQL functions only. Each generator is one pattern, run by the
JVM's regular expressions over whole texts; the lengths of a text's matches
and of the gaps between them give every candidate's offsets. The four base
kinds have checks of their own (parts up to 255, digits, Luhn) and always
stay. The loose generators propose more spans: numbers written like telephone
numbers without a leading plus, and e-mail addresses with spelled-out signs.
Of a run of digits and separators, every run of consecutive groups with 7 to
15 digits is proposed, up to 15 from each group. Gradient-boosted trees score each from its format (digits,
groups, separators) and its context (characters and key words around it); a
proposal is added where no base span overlaps it, its score reaches its
generator's threshold and no better proposal that is added overlaps it.

The trees are trained here, by Spark's GBT learner on ``examples`` labelled
rows written from number and address formats, a third of which sets the
thresholds (the lowest at which the given share of what it selects is personal
data). They are then applied as one SQL expression per tree.
"""

from __future__ import annotations

from itertools import groupby

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import written

#: Base kinds in the order that breaks ties, then what the generators add.
KINDS = ("email", "ip", "card", "phone", "email_like", "phone_like")

#: Patterns of the base kinds and of the loose generators. Repetitions that
#: nothing follows are possessive: the same matches, no backtracking.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)++",
    "ip": r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "email_like": r"[A-Za-z0-9._%+-]+\x20?(?:@|\(at\)|\[at\])\x20?[A-Za-z0-9-]+(?:\x20?(?:\.|\(dot\)|\[dot\])\x20?[A-Za-z0-9-]+)++",
    "phone_like": r"\(?[0-9](?=(?:[\x20().-]*+[0-9]){6})[\x20().0-9-]*+",
}
_SIDE = 24
#: Groups of digits in a proposal at most: as many as digits.
_MOST = 15


def _may_hold(kind: str, text: Column) -> Column:
    """A cheap test that a text without such spans mostly fails."""
    at = text.contains("@")
    if kind == "email":
        return at
    if kind == "email_like":
        return at | text.contains("(at)") | text.contains("[at]")
    if kind == "phone":
        return text.contains("+")
    if kind == "ip":
        return text.rlike(r"[0-9]\.[0-9]")
    return text.rlike("[0-9]")


def _proposals(text: Column) -> Column:
    """Array of (kind, place, gap, match, left, right): each generator's
    matches in text order, the length of the gap before each, and what stands
    on either side."""
    def of(kind: str) -> Column:
        gaps, hits = F.split(text, PATTERNS[kind], -1), F.regexp_extract_all(text, F.lit(PATTERNS[kind]), F.lit(0))
        rows = F.transform(F.arrays_zip(hits.alias("m"), gaps.alias("g"), F.slice(gaps, 2, F.size(gaps)).alias("r")), lambda x, i: F.struct(
            F.lit(kind).alias("kind"), i.alias("place"), F.length(x["g"]).alias("gap"), x["m"].alias("match"),
            F.right(x["g"], F.lit(_SIDE)).alias("left"), F.left(x["r"], F.lit(_SIDE)).alias("right")))
        rows = F.filter(rows, lambda x: x["match"].isNotNull())
        return F.when(_may_hold(kind, text), rows).otherwise(F.array().cast(
            "array<struct<kind:string,place:int,gap:int,match:string,left:string,right:string>>"))

    return F.concat(*[of(k) for k in KINDS])


def _located(rows: DataFrame) -> DataFrame:
    """``rows`` (rid, kind, place, gap, match, ...) with start and end."""
    before = Window.partitionBy("rid", "kind").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.length("match")).over(before)
    return rows.withColumn("end", end.cast("int")).withColumn("start", (F.col("end") - F.length("match")).cast("int"))


def _spread(rows: DataFrame) -> DataFrame:
    """``rows`` with each run of ``phone_like`` replaced by its runs of consecutive groups that have 7 to
    15 digits and at most two characters between them."""
    run = F.col("kind") == "phone_like"
    seps, nums = F.split("match", "[0-9]+", -1), F.regexp_extract_all("match", F.lit("[0-9]+"), F.lit(0))
    parts = F.filter(F.arrays_zip(seps.alias("sep"), nums.alias("num")), lambda x: x["num"].isNotNull())
    whole = F.array(F.struct(F.lit("").alias("sep"), F.col("match").alias("num")))
    rows = rows.withColumns({"parts": F.when(run, parts).otherwise(whole), "tail": F.when(run, F.element_at(seps, -1)).otherwise("")})
    rows = rows.select("rid", "kind", "start", "left", F.concat("tail", "right").alias("right"), F.posexplode("parts").alias("j", "part")).select("*", "part.*")
    w = Window.partitionBy("rid", "kind", "start").orderBy("j")
    said = F.concat("sep", "num")
    rows = rows.withColumns({
        "to": F.sum(F.length("sep") + F.length("num")).over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("int"),
        "before": F.array_join(F.collect_list(F.when(run, said)).over(w.rowsBetween(-_SIDE, -1)), ""),
        "ahead": F.collect_list(F.when(run, F.col("part"))).over(w.rowsBetween(0, _MOST - 1)),
        "after": F.collect_list(F.when(run, said)).over(w.rowsBetween(1, _MOST - 1 + _SIDE))})
    opens = F.col("sep").endswith("(")
    first = F.when(opens, "(").otherwise("")
    digits = lambda k: F.aggregate(F.slice("ahead", 1, k), F.lit(0), lambda a, x: a + F.length(x["num"]))
    near = lambda k: F.forall(F.slice("ahead", 2, k - 1), lambda x: F.length(x["sep"]) <= 2)
    text = lambda k: F.concat(first, F.element_at("ahead", 1)["num"], F.array_join(F.slice("after", 1, k - 1), ""))
    found = F.transform(F.filter(F.sequence(F.lit(1), F.size("ahead")), lambda k: digits(k).between(7, 15) & near(k)), lambda k: F.struct(
        text(k).alias("match"), F.left(F.concat(F.array_join(F.slice("after", k, _SIDE), ""), F.col("right")), F.lit(_SIDE)).alias("right")))
    begin = F.col("start") + F.when(run, F.col("to") - F.length("num") - F.when(opens, 1).otherwise(0)).otherwise(0)
    lead = F.concat("left", "before", F.when(run, F.when(opens, F.expr("left(sep, length(sep) - 1)")).otherwise(F.col("sep"))).otherwise(""))
    rows = rows.select("rid", "kind", begin.cast("int").alias("start"), F.right(lead, F.lit(_SIDE)).alias("left"), F.explode(
        F.when(run, found).otherwise(F.array(F.struct(F.col("num").alias("match"), F.col("right"))))).alias("x")).select("rid", "kind", "start", "left", "x.*")
    return rows.withColumn("end", (F.col("start") + F.length("match")).cast("int"))


def _luhn(digits: Column) -> Column:
    """Whether a short string of digits passes the Luhn check."""
    d = F.transform(F.split(F.reverse(digits), ""), lambda x, i: F.when(i % 2 == 0, x.cast("int")).otherwise(
        x.cast("int") * 2 - F.when(x.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(d, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0))) % 10 == 0


def _passes() -> Column:
    """Whether a match of a base kind stands up to its check."""
    digits = F.regexp_replace("match", "[^0-9]", "")
    n = F.length(digits)
    parts = F.forall(F.split("match", r"\."), lambda p: p.cast("double") <= 255)
    return (F.when(F.col("kind") == "email", True)
            .when(F.col("kind") == "ip", parts)
            .when(F.col("kind") == "card", n.between(14, 19) & F.when(n.between(14, 19), _luhn(digits)).otherwise(False))
            .when(F.col("kind") == "phone", n.between(10, 15)).otherwise(False))


#: Context words, per feature.
_CONTEXT = {
    "says_phone": "phone|tel|call|fax|mobile|cell|contact|reach|dial|sms|whatsapp",
    "says_mail": "mail|contact|write|reach|address|reply",
    "says_number": "order|invoice|version|isbn|page|no\\.|number|ticket|case|total|amount|id|ref|serial|pi|year|date|usd|eur",
}


def features() -> dict[str, Column]:
    """Format and context features of a proposal (match, left, right)."""
    m = F.col("match")
    count = lambda p: F.regexp_count(m, F.lit(p)).cast("double")
    groups = F.filter(F.split(m, "[^0-9]+"), lambda x: x != "")
    at = lambda i: F.coalesce(F.length(F.try_element_at(groups, F.lit(i))), F.lit(0)).cast("double")
    near = F.lower(F.concat(F.col("left"), F.lit(" "), F.substring("right", 1, 8)))
    out = {
        "length": F.length(m).cast("double"), "digits": count("[0-9]"), "groups": F.size(groups).cast("double"),
        "first": at(1), "second": at(2), "third": at(3), "last": at(-1), "letters": count("[A-Za-z]"),
        "dots": count(r"\."), "dashes": count("-"), "spaces": count(r"\x20"), "brackets": count(r"[()\[\]]"),
        "signs": count("@"), "spelled": count(r"[\[(](?:at|dot)[\])]"),
        "glued_left": F.when(F.col("left").rlike(r"[A-Za-z0-9@#_/.+-]$"), 1.0).otherwise(0.0),
        "glued_right": F.when(F.col("right").rlike(r"^(?:[A-Za-z0-9@_/-]|\.[0-9])"), 1.0).otherwise(0.0),
        "year": F.when(m.rlike("^(?:19|20)[0-9]{2}(?![0-9])"), 1.0).otherwise(0.0),
        "more_left": F.when(F.col("left").rlike(r"[0-9][\x20().-]{0,2}$"), 1.0).otherwise(0.0),
        "more_right": F.when(F.col("right").rlike(r"^[\x20().-]{0,2}[0-9]"), 1.0).otherwise(0.0),
        "joined_left": F.when(F.col("left").rlike(r"[0-9][().-][\x20]?$"), 1.0).otherwise(0.0),
        "joined_right": F.when(F.col("right").rlike(r"^[().-][0-9]"), 1.0).otherwise(0.0),
        "is_mail": F.when(F.col("kind") == "email_like", 1.0).otherwise(0.0),
    }
    return out | {k: F.when(near.rlike(rf"(?<![a-z])(?:{v})"), 1.0).otherwise(0.0) for k, v in _CONTEXT.items()}


# --- labelled rows and the trees -------------------------------------------

def labelled(spark: SparkSession, examples: int, seed: int) -> DataFrame:
    """(kind, left, match, right, label, fold): rows written from formats, a
    seeded hash choosing the format and its digits and words."""
    salt = iter(range(1, 1000))
    h = lambda n: F.pmod(F.xxhash64(F.col("id"), F.lit(seed), F.lit(next(salt))), F.lit(n))
    d = lambda n: F.lpad(h(10 ** n).cast("string"), n, "0")
    of = lambda *xs: F.element_at(F.array(*map(F.lit, xs)), (h(len(xs)) + 1).cast("int"))
    w = lambda: F.concat(of("an", "th", "re", "mar", "jo", "li", "os"), of("er", "on", "sa", "ing", "ha"), of("", "x", "ty", "nd"))
    c = lambda *xs: F.concat(*[F.lit(x) if isinstance(x, str) else x for x in xs])
    sep = of(" ", "-", ".")
    yes = [  # personal data
        ("phone_like", c("(", d(3), ") ", d(3), "-", d(4))), ("phone_like", c(d(3), "-", d(3), "-", d(4))),
        ("phone_like", c(d(3), sep, d(3), sep, d(4))), ("phone_like", c("0", d(2), " ", d(4), " ", d(4))),
        ("phone_like", c("0", d(3), " ", d(6))), ("phone_like", c("(0", d(2), ") ", d(4), "-", d(4))),
        ("email_like", c(w(), ".", d(2), " (at) ", w(), ".com")), ("email_like", c(w(), "[at]", w(), "[dot]org")),
        ("email_like", c(w(), " [at] ", w(), " [dot] ", w())), ("email_like", c(w(), ".", w(), "@", w(), " . com")),
    ]
    no = [  # look-alikes
        ("phone_like", c("20", d(2), "-0", h(9).cast("string"), "-", d(2))), ("phone_like", c(d(2), ".", d(2), ".20", d(2))),
        ("phone_like", d(8)), ("phone_like", d(11)), ("phone_like", d(14)), ("phone_like", c("1", ".", d(8))),
        ("phone_like", c(h(9).cast("string"), " ", d(3), " ", d(3))), ("phone_like", c("978-", d(1), "-", d(2), "-", d(6), "-", d(1))),
        ("phone_like", c("19", d(2), "-20", d(2))), ("phone_like", c(d(2), ".", d(1), ".", d(2), ".", d(3))),
        ("phone_like", c(d(4), " ", d(4), " ", d(4), " ", d(2))), ("phone_like", c("20", d(2), "-", d(6))),
        ("phone_like", c(d(3), ".", d(2), ".", d(3), ".", d(2))), ("phone_like", d(16)), ("phone_like", c(d(8), " 20", d(2), "-0", h(9).cast("string"))),
        ("phone_like", c(h(9).cast("string"), " ", h(9).cast("string"), ".", d(8))), ("email_like", c(w(), " @ ", w(), ".", w(), " ", ".")),
        ("email_like", c(w(), "@", d(1), ".", d(1))), ("email_like", c("v", d(1), " @ ", d(1), ".", d(2))),
    ]

    base = spark.range(examples)
    label = h(2)
    pick = lambda rows: [F.struct(F.lit(k).alias("kind"), m.alias("match")) for k, m in rows]
    made = F.when(label == 1, F.element_at(F.array(*pick(yes)), (h(len(yes)) + 1).cast("int"))).otherwise(
        F.element_at(F.array(*pick(no)), (h(len(no)) + 1).cast("int")))
    number = c(d(3), "-", d(3), "-", d(4))
    parts = [  # of a number, or more than one number: left, match, right
        (c(d(3), "-"), c(d(3), "-", d(4)), ""), ("", number, c(" ", number)), (c(number, " "), number, ""), (c("20", d(2), " "), number, ""),
        ("", c(number, " ", d(3)), c("-", d(3), "-", d(4))), ("", c(number, " ", d(2)), ""), (c(d(3), "-"), c(d(3), "-", d(4), " ", d(3)), c("-", d(3), "-", d(4))),
        ("", c("20", d(2), " ", number), ""), ("", c(h(9).cast("string"), " ", number), ""), (c(h(9).cast("string"), " "), number, ""),
        ("", c("20", d(2), " ", d(3), "-", d(3)), c("-", d(4))), (c("(", d(3), ") "), c(d(3), "-", d(4)), ""), ("", c("(", d(3), ") ", d(3), "-", d(4)), c(" (", d(3), ") ", d(3), "-", d(4))),
        ("", number, c(" (", d(3), ") ", d(3), "-", d(4))), ("", number, c(". ", number)), (c(h(9).cast("string"), " "), c("0", d(2), " ", d(4), " ", d(4)), ""),
        ("", c(h(9).cast("string"), " 0", d(2), " ", d(4), " ", d(4)), ""), (c("0", d(2), " "), c(d(4), " ", d(4)), ""), ("", c(d(3), "-", d(4)), c(" ", number)),
        ("", c("0", d(2), " ", d(4)), c(" ", d(4))), (c(d(4), " "), number, ""), ("", c(d(4), " ", number), ""),
        ("", c("19", d(2), " ", number), ""), ("", c("20", d(2), " (", d(3), ") ", d(3), "-", d(4)), ""), ("", c("20", d(2), " ", d(3), sep, d(3), sep, d(4)), ""),
        ("", c("20", d(2), " ", number), c(" ", d(3))), ("", c(d(2), " ", number), ""), ("", c(d(3), " ", number), "")]
    whole = {1, 2, 3, 9, 12, 13, 14, 15, 20}
    of_part = lambda k: F.element_at(F.array(*[F.lit(x[k]) if isinstance(x[k], str) else x[k] for x in parts]), which + 1)
    left = F.when(h(2) == 0, c(w(), " ", w(), " ", w(), of(" ", ". ", ", ", "\n"))).when(
        label == 1, of("call ", "phone: ", "tel. ", "contact ", "write to ", "reach me at ", "mobile ", "mail ")).otherwise(
        of("order ", "invoice ", "version ", "page ", "isbn ", "no. ", "total ", "id ", "on ", "pi is ", "/", "x", 'key = "8b', "9d4f", "a5", "#", "sha c2e"))
    right = c(F.when(label == 1, of(" ", ".", ",", "\n", ")", "")).otherwise(of("", " ", ".", ",", "f6d", "be", "/")),
              F.when(label == 1, of("\n", " ", "  ")).otherwise(""), w(), " ", w())
    which = h(len(parts)).cast("int")
    split = h(3) == 0                                  # a third of the rows: parts of numbers, and numbers beside others
    label = F.when(split, which.isin(*whole).cast("int")).otherwise(label)
    made = F.when(split, F.struct(F.lit("phone_like").alias("kind"), of_part(1).alias("match"))).otherwise(made)
    lead = F.when(split, of_part(0)).otherwise("")
    left = c(F.when(split, F.when(h(2) == 0, c(w(), " ", w(), " ")).otherwise(of("call ", "phone: ", "tel. ", "", "\n"))).otherwise(left), lead)
    right = c(F.when(split, of_part(2)).otherwise(""), F.when(split, of(" ", ".", ",", "\n", "")).otherwise(""), right)
    return base.select(label.cast("double").alias("label"), made.alias("x"), F.right(left, F.lit(_SIDE)).alias("left"), F.left(right, F.lit(_SIDE)).alias("right"),
                       (F.col("id") % 3 == 0).alias("held")).select("label", "x.*", "left", "right", "held")


def _sql(node, names: list[str]) -> str:
    """A tree of the learner as nested CASE expressions."""
    if node.subtreeDepth() == 0:
        return repr(float(node.prediction()))
    split = node.split()
    return (f"CASE WHEN {names[split.featureIndex()]} <= {float(split.threshold())!r}D THEN {_sql(node.leftChild(), names)} "
            f"ELSE {_sql(node.rightChild(), names)} END")


_TRAINED: dict[tuple, tuple[list[str], dict[str, float]]] = {}


#: Trees in one projection: their code, and that of each feature's projection, stays below the JVM's limit for a method.
_TREES = 3


def _with_margin(rows: DataFrame, parts: list[str]) -> DataFrame:
    """``rows`` with column ``margin``. The summands are not deterministic in name, so that Catalyst neither merges their
    projections nor moves a filter below them: the trees are computed once, from finished features."""
    for i, part in enumerate(parts):
        rows = rows.select("*", F.when(F.spark_partition_id() >= 0, F.expr(part)).alias(f"m_{i}"))
    return rows.withColumn("margin", sum((F.col(f"m_{i}") for i in range(1, len(parts))), F.col("m_0")))


def trained(spark: SparkSession, examples: int = 3000, trees: int = 12, depth: int = 4, precision: float = 0.98,
            seed: int = 42) -> tuple[list[str], dict[str, float]]:
    """(the margin's summands as SQL over the features, threshold per generator), trained
    once per process."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler

    key = (examples, trees, depth, precision, seed)
    if key not in _TRAINED:
        rows = written(labelled(spark, examples, seed), "labelled")       # what follows reads finished strings
        rows = written(rows.select("*", *[v.alias(f"f_{k}") for k, v in features().items()]), "learned-from")
        names = [c for c in rows.columns if c.startswith("f_")]
        data = VectorAssembler(inputCols=names, outputCol="x").transform(rows)
        model = GBTClassifier(featuresCol="x", labelCol="label", maxIter=trees, maxDepth=depth, stepSize=0.3,
                              seed=seed, maxBins=32).fit(data.where("not held").coalesce(2))
        each = [f"{float(w)!r}D * ({_sql(t._call_java('rootNode'), names)})".replace("THEN -", "THEN 0.0D - ").replace("ELSE -", "ELSE 0.0D - ")
                for w, t in zip(model.treeWeights, model.trees)]
        parts = [" + ".join(each[i:i + _TREES]) for i in range(0, len(each), _TREES)]
        thresholds = {}
        held = _with_margin(rows.where("held"), parts).select("kind", "label", "margin").collect()
        for kind in ("email_like", "phone_like"):
            best, good, total = float("inf"), 0, 0
            for margin_of, tied in groupby(sorted((-r.margin, int(r.label)) for r in held if r.kind == kind), key=lambda x: x[0]):
                said = [y for _, y in tied]            # equal margins are selected together or not at all
                total, good = total + len(said), good + sum(said)
                if good >= precision * total:
                    best = -margin_of
            thresholds[kind] = best
        _TRAINED[key] = parts, thresholds
    return _TRAINED[key]


# --- the operator ----------------------------------------------------------

#: Elements appended to one piece of a list.
_PIECE = 256


def _append(list_: Column, x: Column) -> Column:
    """``list_`` (pieces, last) with ``x`` behind: only the last piece is copied, so that a long list grows in linear time."""
    full = F.size(list_["last"]) >= _PIECE
    return F.when(full, F.struct(F.concat(list_["pieces"], F.array(list_["last"])).alias("pieces"), F.array(x).alias("last"))).otherwise(
        F.struct(list_["pieces"].alias("pieces"), F.concat(list_["last"], F.array(x)).alias("last")))


def _listed(list_: Column) -> Column:
    return F.flatten(F.concat(list_["pieces"], F.array(list_["last"])))


def _best_apart(spans: Column, longest: Column) -> Column:
    """Of an array of proposals (end, start, kind, gain > 0) sorted by end, none longer than ``longest``, the ones apart from each other with
    the largest total gain. Two sweeps: the first keeps, per proposal, whether the best choice up to its end holds it,
    looking back no further than the longest proposal; the second reads the choice off from the last end on."""
    empty = F.from_json(F.lit('{"sums":[{"end":-1,"sum":0.0}],"held":{"pieces":[],"last":[]}}'),
                        "struct<sums:array<struct<end:int,sum:double>>,held:struct<pieces:array<array<boolean>>,last:array<boolean>>>")
    none = F.struct(F.array(F.slice(spans, 1, 0)).alias("pieces"), F.slice(spans, 1, 0).alias("last"))

    def ahead(acc: Column, x: Column) -> Column:
        sums = acc["sums"]                             # best totals at recent ends, ascending; none falls
        free = F.array_max(F.transform(sums, lambda y: F.when(y["end"] <= x["start"], y["sum"])))
        so_far = F.element_at(sums, -1)["sum"]
        # needed by later starts: ends behind the longest reach back, and the last one before
        kept = F.filter(sums, lambda y, i: (y["end"] > x["end"] - longest) | (F.get(sums, i + 1)["end"] > x["end"] - longest) | (i + 1 == F.size(sums)))
        now = F.struct(x["end"].alias("end"), F.greatest(free + x["gain"], so_far).alias("sum"))
        return F.struct(F.concat(kept, F.array(now)).alias("sums"), _append(acc["held"], free + x["gain"] > so_far).alias("held"))

    held = F.aggregate(spans, empty, ahead, lambda acc: _listed(acc["held"]))
    back = F.reverse(F.arrays_zip(spans.alias("x"), held.alias("h")))
    return F.aggregate(back, F.struct(F.lit(2 ** 31 - 1).alias("limit"), none.alias("out")), lambda acc, y: F.when(
        y["h"] & (y["x"]["end"] <= acc["limit"]), F.struct(y["x"]["start"].alias("limit"), _append(acc["out"], y["x"]).alias("out"))).otherwise(acc),
        lambda acc: _listed(acc["out"]))


def find(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **training) -> DataFrame:
    """(id, base, spans) of every row of ``df``: base findings and all findings, each an array of
    (kind, start, end) by start, then kind in the order of :data:`KINDS`; offsets are code points,
    the end exclusive. Of proposals that overlap each other those apart with the largest total of margins above
    their thresholds are added; of equal totals the one that does without a later proposal.

    Null and empty texts have no findings; a null id stays null; repeated rows are returned as often as
    they come; an empty table gives an empty result; other columns are not read. Texts are read once;
    only proposals (match and a few characters around it) are shuffled, by text. The work is linear in a text's proposals."""
    spark = df.sparkSession
    parts, thresholds = trained(spark, **training)
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = written(df.select(F.monotonically_increasing_id().alias("rid"), F.col(f"`{id_col}`").alias("id"),
                             _proposals(text).alias("proposals")), "proposals")
    each = _located(rows.where(F.size("proposals") > 0).select("rid", F.explode("proposals").alias("p")).select("rid", "p.*"))
    loose = F.col("kind").isin("email_like", "phone_like")
    each = _spread(each.where(loose | _passes()))
    each = _with_margin(each.select("*", *[v.alias(f"f_{k}") for k, v in features().items()]), parts)
    least = F.when(F.col("kind") == "email_like", thresholds["email_like"]).otherwise(thresholds["phone_like"])
    gain = F.when(loose, F.col("margin") - least)
    chosen = each.where(~loose | (gain >= 0)).select("rid", "kind", "start", "end", (~loose).alias("is_base"), (gain + 1e-9).alias("gain"))
    # a proposal goes where a base span overlaps it: one that reaches past its start, or that starts before its end
    base_end, base_start = F.when(F.col("is_base"), F.col("end")), F.when(F.col("is_base"), F.col("start"))
    reach = F.max(base_end).over(Window.partitionBy("rid").orderBy("start", F.desc("is_base")).rowsBetween(Window.unboundedPreceding, -1))
    ahead = F.min(base_start).over(Window.partitionBy("rid").orderBy(F.desc("start"), "is_base").rowsBetween(Window.unboundedPreceding, -1))
    chosen = chosen.withColumns({"reach": reach, "ahead": ahead}).where(
        F.col("is_base") | ((F.coalesce("reach", F.lit(0)) <= F.col("start")) & (F.col("ahead").isNull() | (F.col("ahead") >= F.col("end")))))
    # proposals that overlap each other form a chain
    order = Window.partitionBy("rid", "is_base").orderBy("start", "end")
    past = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    chosen = chosen.withColumn("new", F.when(F.col("is_base") | past.isNull() | (past <= F.col("start")), 1).otherwise(0))
    chosen = chosen.withColumn("chain", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    spans = F.sort_array(F.collect_list(F.struct("end", "start", "kind", "gain")))
    chosen = chosen.groupBy("rid", "is_base", "chain").agg(spans.alias("s"), F.max(F.col("end") - F.col("start")).alias("longest"))
    taken = F.when(F.col("is_base"), F.col("s")).otherwise(_best_apart(F.col("s"), F.col("longest")))
    chosen = chosen.select("rid", "is_base", F.explode(taken).alias("t")).select("rid", "is_base", "t.*")
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).cast("int")
    found = chosen.groupBy("rid").agg(F.sort_array(F.collect_list(F.struct("start", rank.alias("k"), "end", "is_base"))).alias("s"))
    span = lambda x: F.struct(F.element_at(F.array(*map(F.lit, KINDS)), x["k"]).alias("kind"), x["start"].alias("start"), x["end"].alias("end"))
    found = found.select("rid", F.transform(F.filter("s", lambda x: x["is_base"]), span).alias("base"), F.transform("s", span).alias("spans"))
    none = F.array().cast("array<struct<kind:string,start:int,end:int>>")
    return rows.select("rid", "id").join(found, "rid", "left").select("id", F.coalesce("base", none).alias("base"), F.coalesce("spans", none).alias("spans"))
