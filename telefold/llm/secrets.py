"""Secret scanning with a random forest that removes false findings, with DataFrame functions only.

A finding is a value after a secret's name and an assignment sign, whatever its length and signs, or a run of at
least 12 letters, digits and +/_.- with a digit in it, which neither begins nor ends with a dot. Its features are its length, its character
classes and the transitions between them, also those between letters that words have, how much of it the
neighbourhood's own words cover (a dictionary of bounded size), the path it was found under and the words around it.
A forest is trained on labelled findings, a bounded sample; the scan itself is map-only.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written
from .columns import aside

SAMPLE_ROWS = 5_000  # labelled findings that training reads at most
DICTIONARY = 500  # words around labelled findings that coverage looks for
NEIGHBOURS = 100  # words before labelled findings that are told apart
PAIRS = 150  # letter pairs of the words around labelled findings, the most frequent ones
TREES, DEPTH, SEED = 40, 8, 17

NUMBERS = ["length", "digits", "upper", "lower", "signs", "changes", "distinct", "hex", "covered", "spoken", "tested", "named", "assigned", "quoted"]

#: fixed values: words of a path that hold examples, and names under which secrets are kept
EXAMPLE_PATH = "(?i)(test|example|sample|fixture|mock|doc)"
SECRET_NAME = "(?i)(pass(word|wd|phrase)?|secret|token|api[_-]?key|access[_-]?key|auth|credential)"
#: what stands between such a name and its value, without the value's quote
ASSIGNED = r"(s|key|value|id|string|code)?([_-][A-Za-z0-9_-]{0,12}|[0-9]{1,3})?[\"'\]]{0,2}[ \t]{0,4}[:=]{1,2}>?[ \t]{0,4}"
#: values that stand for others
PLACEHOLDER = r"(?i)^(none|null|nil|undefined|true|false|str|string|bool|int|required|optional|\*+|x+|\.+|\$\{.*|\$\(.*|<.*>|\{.*\}|%\(.*|%[sd]|[a-z_][a-z0-9_.]*\(.*)$"

_QUOTED = "|".join(rf"(?<={q})(?!{q})[^{q}\\\n]*+(?:\\.[^{q}\\\n]*+){{0,100}}+(?={q})" for q in "\"'`")
# the value's last character is no bracket or separator; the next parameter of a query string isn't part of it
_OPEN = r"(?![:=>]|&\w{1,40}=)[^\s\"'`][^\s\"'`&]*(?:&(?!\w{1,40}=)[^\s\"'`&]*){0,200}(?<![,;)\]}>])"
# the short look back is tried first
VALUE = rf"(?<=[:=]>?[ \t]{{0,4}}[\"'`]?)(?<=(?:{SECRET_NAME}){ASSIGNED}[\"'`]?)(?:{_QUOTED}|{_OPEN})"
RUN = rf"(?:{VALUE})|(?<![A-Za-z0-9+/_-])(?<![A-Za-z0-9+/_-]\.)(?=[A-Za-z+/_.-]*[0-9])[A-Za-z0-9+/_-][A-Za-z0-9+/_.-]{{10,}}[A-Za-z0-9+/_-]={{0,2}}"


@aside
def findings(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row per run, with the columns of ``docs`` but the text, and ``nth int`` (from 0), ``run``, ``before`` and
    ``after``: up to 40 characters of the same line, as far as the findings beside it. Null and empty texts have none;
    equal rows each have theirs."""
    body = F.col(f"`{text}`")
    # what stands between the runs; one piece more than there are runs
    runs, between = F.regexp_extract_all(body, F.lit(RUN), F.lit(0)), F.split(body, RUN, -1)
    names = ["nth", "run", "before", "after"]
    rest = [F.col(f"`{c}`") for c in docs.columns if c != text and c not in names]
    cut = docs.filter(body.rlike(RUN)).select(*rest, runs.alias("__runs"), between.alias("__between"))
    found = F.transform(
        "__runs",
        lambda run, i: F.struct(
            run.alias("run"),
            F.right(F.substring_index(F.get("__between", i), "\n", -1), F.lit(40)).alias("before"),
            F.left(F.substring_index(F.get("__between", i + 1), "\n", 1), F.lit(40)).alias("after"),
        ),
    )
    return cut.select(*rest, F.posexplode(found).alias("nth", "__one")).select(*rest, "nth", "__one.*")


def _share(run: Column, kind: str) -> Column:
    """The share of characters of a kind."""
    return F.char_length(F.regexp_replace(run, f"[^{kind}]" if kind[0] != "^" else f"[{kind[1:]}]", "")) / F.char_length(run)


def features(found: DataFrame, dictionary: list[str], neighbours: dict[str, float], pairs: list[str], path: str | None = None) -> DataFrame:
    """Adds the features NUMBERS and ``neighbour``. A null path has no words."""
    run, before = F.col("run"), F.col("before")
    plain = F.regexp_replace(F.regexp_replace(F.regexp_replace(run, "[A-Z]", "A"), "[a-z]", "a"), "[0-9]", "0")
    kept = F.filter(F.lit(dictionary).cast("array<string>"), lambda w: F.contains(F.lower(run), w))
    covered = F.aggregate(kept, F.lit(0), lambda n, w: n + F.char_length(w)) / F.char_length(run)
    letters = F.split(F.lower(run), "")
    n = F.greatest(F.size(letters) - 1, F.lit(0))
    steps = F.zip_with(F.slice(letters, F.lit(1), n), F.slice(letters, F.lit(2), n), lambda a, b: F.concat(a, b))
    spoken = F.size(F.filter(steps, lambda pair: F.array_contains(F.lit(pairs).cast("array<string>"), pair)))
    where = F.coalesce(F.col(f"`{path}`").cast("string"), F.lit("")) if path else F.lit("")
    known = F.create_map(*(F.lit(x) for item in neighbours.items() for x in item)) if neighbours else None
    return found.withColumns({
        "length": F.char_length(run).cast("double"),
        "digits": _share(run, "0-9"),
        "upper": _share(run, "A-Z"),
        "lower": _share(run, "a-z"),
        "signs": _share(run, "^A-Za-z0-9"),
        # a run of one kind shrinks to one character
        "changes": (F.char_length(F.regexp_replace(plain, r"(.)\1+", "$1")) - 1) / F.char_length(run),
        "distinct": F.size(F.array_distinct(F.split(run, ""))) / F.char_length(run),
        "hex": run.rlike("^[0-9a-f]+$").cast("double"),
        "covered": F.least(covered, F.lit(1.0)),
        "spoken": spoken / F.greatest(n, F.lit(1)),
        "tested": where.rlike(EXAMPLE_PATH).cast("double"),
        "named": before.rlike(SECRET_NAME + "[^\\n]{0,6}$").cast("double"),
        "assigned": before.rlike("[:=]>?\\s*[\"'`]?$").cast("double"),
        "quoted": before.rlike("[\"'`]$").cast("double"),
        "neighbour": F.coalesce(known[word_before(before)], F.lit(0.5)) if known is not None else F.lit(0.5),
    })


def word_before(before: Column) -> Column:
    """The last word before a finding, lower-cased; empty if there is none."""
    return F.lower(F.regexp_extract(before, r"(\p{L}+)\P{L}*$", 1))


class Forest:
    """A trained forest with the words its features need."""

    def __init__(self, dictionary: list[str], neighbours: dict[str, float], pairs: list[str], model: RandomForestClassificationModel | None, share: float):
        self.dictionary, self.neighbours, self.pairs, self.model, self.share = dictionary, neighbours, pairs, model, share


def train(labelled: DataFrame, label: str = "label", path: str | None = None, rows: int = SAMPLE_ROWS, always: DataFrame | None = None) -> Forest:
    """Fits on the ``rows`` findings of smallest hash whose ``label`` is 0 or 1, and on all of ``always``, a bounded
    set that may lack the path. If all have one label, every score is their share of ones; without any it is a half."""
    y = F.col(f"`{label}`")
    key = F.xxhash64("run", "before", "after")
    sample = labelled.filter(y.isin(0, 1)).withColumn("__y", y.cast("double")).withColumn("__h", key).orderBy("__h", "run", "before", "after", "__y", "nth").limit(rows)
    if always is not None:
        named = ["run", "before", "after", "__y", *([path] if path else [])]
        more = always.withColumn("__y", F.col(f"`{label}`").cast("double"))
        sample = sample.select(*(F.col(f"`{c}`") for c in named)).unionByName(more.select(*(F.col(f"`{c}`") for c in named if c in more.columns)), allowMissingColumns=True)
    sample = written(sample.coalesce(1), "findings")
    n, ones = sample.agg(F.count(F.lit(1)), F.sum("__y")).first()
    around = sample.select(F.explode(F.split(F.lower(F.concat_ws(" ", "before", "after")), r"\P{L}+")).alias("w")).filter("char_length(w) >= 4")
    dictionary = [r["w"] for r in around.groupBy("w").count().orderBy(F.desc("count"), "w").limit(DICTIONARY).collect()]
    steps = F.regexp_extract_all("w", F.lit("(?=([a-z]{2}))"), F.lit(1))
    pairs = [r["p"] for r in around.select(F.explode(steps).alias("p")).groupBy("p").count().orderBy(F.desc("count"), "p").limit(PAIRS).collect()]
    words = sample.groupBy(word_before(F.col("before")).alias("w")).agg(F.count(F.lit(1)).alias("n"), F.sum("__y").alias("ones"))
    words = words.filter("n >= 5").orderBy(F.desc("n"), "w").limit(NEIGHBOURS).collect()
    neighbours = {r["w"]: (r["ones"] + 1) / (r["n"] + 2) for r in words}
    if not n or ones in (0, n):
        return Forest(dictionary, neighbours, pairs, None, ones / n if n else 0.5)
    assembler = VectorAssembler(inputCols=[*NUMBERS, "neighbour"], outputCol="__x")
    forest = RandomForestClassifier(featuresCol="__x", labelCol="__y", numTrees=TREES, maxDepth=DEPTH, seed=SEED, probabilityCol="__p", predictionCol="__c", rawPredictionCol="__r")
    return Forest(dictionary, neighbours, pairs, forest.fit(assembler.transform(features(sample, dictionary, neighbours, pairs, path))), ones / n)


def score(found: DataFrame, forest: Forest, path: str | None = None) -> DataFrame:
    """Adds ``score double``, the forest's probability that a finding is a secret. Map-only."""
    if forest.model is None:
        return found.withColumn("score", F.lit(float(forest.share)))
    made = [*NUMBERS, "neighbour"]
    inner = found.select(F.struct(*(F.col(f"`{c}`") for c in found.columns)).alias("__row"), "run", "before", *([F.col(f"`{path}`").alias("__path")] if path else []))
    inner = features(inner, forest.dictionary, forest.neighbours, forest.pairs, "__path" if path else None)
    scored = forest.model.transform(VectorAssembler(inputCols=made, outputCol="__x").transform(inner))
    return scored.select("__row.*", vector_to_array("__p")[1].alias("score"))


def rule_label(run: Column, before: Column) -> Column:
    """Labels for findings that a rule can tell: 1 for key ids of a known form and values under a secret's name, 0 for
    plain and dotted numbers, universally unique ids, checksums named as such, names of files and hosts, and what
    stands for a value under a secret's name; null for all others, plain words under such a name too."""
    named = before.rlike(SECRET_NAME + ASSIGNED + "[\"'`]?$")
    harmless = run.rlike("^[0-9.]+$") | run.rlike("^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$") | before.rlike("(?i)(sha|md5|commit|checksum|digest|hash)[^\\n]{0,6}$")
    harmless |= run.rlike("(?i)^[a-z0-9_./-]+[.](com|org|net|html?|php|py|js|css|png|jpe?g|gif|pdf|txt|json|csv)$")
    word = run.rlike("^[A-Za-z]?[a-z]*$") & ~before.rlike("[\"'`]$")
    told = F.when(run.rlike("^AKIA[0-9A-Z]{16}$"), 1).when(named & run.rlike(PLACEHOLDER), 0).when(named & ~word, 1)
    return told.when(~named & harmless, 0)
