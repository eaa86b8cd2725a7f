"""Personal data: base patterns, and weakly supervised spans beside them.

Four base kinds are found by pattern and check (email, ip, card, phone). Other candidates are long
digit groups (``id``) and every two neighbouring words with a capital, in any script, that have some
labeler's vote (``name``). Four labelers vote on every span, base spans included: a strict shape, a gazetteer, words
before it, and what surrounds it. Expectation-maximisation estimates each labeler's reliability
from the counts of vote patterns; the posteriors then train a logistic classifier over votes, kind,
length and digit share. Candidates it is sure of are added; base spans always stay.

Only counts of (votes, features) patterns leave the executors: at most 3^4 * 2 * 3 * 3 rows, whatever the
input. Fitting is arithmetic over those few rows; finding, voting and scoring are Column expressions.

Texts are scanned by patterns that never restart inside a run and have no unbounded groups, so very
long runs of digits or letters neither recurse nor take quadratic time.

Cases: a null or empty text has no spans; repeated rows are treated alike; an empty table gives an
empty result, nothing is fitted then and nothing added; other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skytally.llm.quality import let
from skytally.llm.registry import read, register
from skytally.operators.joins import with_computed

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "id", "name")

# A match of the base pattern starts where a run starts, or where the match before it ended.
LOCAL, DOMAIN = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
EMAIL = f"(?:\\G|(?<!{LOCAL})){LOCAL}++@{DOMAIN}++(?:[.]{DOMAIN}++)++"
IP = "(?<![0-9])[0-9]++[.][0-9]++[.][0-9]++[.][0-9]++"
# Digit groups joined by single separators, whole, of 13 to 19 digits.
CARD = "(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){12,18}(?![ -]?[0-9])"
PHONE = "[+][0-9][ ().0-9-]+[0-9]"
ID = "(?<![A-Za-z0-9+.-])(?:[A-Z]{2})?[0-9](?:[ .-]?[0-9A-Z]){5,33}(?![A-Za-z0-9]|[ .-][0-9])"
# Runs of capitalised words, of which each two neighbours can be a name.
NAME = r"(?<!\p{L})\p{Lu}\p{L}*+(?:[.]? \p{Lu}\p{L}*+)++"
WORD = r"^\p{Lu}\p{L}*"

# Word lists of the labelers.
TITLES = ("Mr", "Mrs", "Ms", "Miss", "Dr", "Prof", "Herr", "Frau", "Madame", "Monsieur", "Señor", "Señora")
GIVEN_NAMES = (
    "James", "John", "Robert", "Michael", "William", "David", "Richard", "Thomas", "Charles", "Daniel",
    "Mary", "Patricia", "Jennifer", "Linda", "Elizabeth", "Barbara", "Susan", "Jessica", "Sarah", "Karen",
    "Hans", "Peter", "Klaus", "Anna", "Ursula", "Jean", "Pierre", "Marie", "Claire", "Juan", "Carlos",
    "Luis", "Carmen", "Ana", "Maria",
)
CUES = "(?i)(phone|tel|mobile|call|contact|fax|ssn|social|passport|iban|account|card|id|name|born|email|mail)[.:# ]*$"
COUNTER_CUES = "(?i)(page|chapter|figure|table|version|isbn|section|part|line|row|year)[.:# ]*$"
STRICT = ("^([0-9]{3}-[0-9]{2}-[0-9]{4}|[A-Z]{2}[0-9]{2} ?[A-Z0-9]{4}[A-Z0-9 ]{7,26}"
          "|[(]?[0-9]{3}[)]?[ .-][0-9]{3}[ .-][0-9]{4})$")
BEFORE = 24

LABELERS = ("shape", "gazetteer", "context", "surroundings")
THRESHOLD = 0.9
EM_ROUNDS, FIT_ROUNDS, RATE, RIDGE = 50, 300, 0.5, 0.01


def _found(t: Column, pattern: str, guard: str) -> Column:
    """Array of (start, end, match, before) of the leftmost non-overlapping matches."""
    def place(pieces: Column) -> Column:
        def all_of(matches: Column) -> Column:
            first = F.struct(F.lit(0).alias("at"), F.array().cast(
                "array<struct<start:int,end:int,match:string,before:string>>").alias("out"))

            def step(acc: Column, k: Column) -> Column:
                start = acc["at"] + F.length(F.get(pieces, k))
                match = F.get(matches, k)
                span = F.struct(start.alias("start"), (start + F.length(match)).alias("end"), match.alias("match"),
                                F.right(F.get(pieces, k), F.lit(BEFORE)).alias("before"))
                return F.struct((start + F.length(match)).alias("at"), F.concat(acc["out"], F.array(span)).alias("out"))

            return F.when(F.size(matches) > 0, F.aggregate(
                F.sequence(F.lit(0), F.size(matches) - 1), first, step, lambda acc: acc["out"]))
        return let(F.regexp_extract_all(t, F.lit(pattern), F.lit(0)), all_of)

    nothing = F.array().cast("array<struct<start:int,end:int,match:string,before:string>>")
    return F.coalesce(F.when(t.rlike(guard), let(F.split(t, pattern, -1), place)), nothing)


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]+", "")


def _luhn(match: Column) -> Column:
    def total(digits: Column) -> Column:
        def add(acc: Column, i: Column) -> Column:
            d = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
            twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
            return acc + F.when(i % 2 == 1, twice).otherwise(d)
        return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add) % 10 == 0
    return let(_digits(match), total)


def _ip_valid(match: Column) -> Column:
    bare = lambda part: F.ltrim(part, F.lit("0"))
    return F.forall(F.split(match, "[.]"), lambda p: (F.length(bare(p)) <= 3) & (
        F.coalesce(F.when(F.length(bare(p)).between(1, 3), bare(p)).cast("int"), F.lit(0)) <= 255))


def _phone_valid(match: Column) -> Column:
    return F.length(_digits(match)).between(9, 15)


def _id_valid(match: Column) -> Column:
    return (F.length(_digits(match)) >= 7) & match.rlike("^([0-9]|[A-Z]{2}[0-9])")


def _neighbours(found: Column) -> Column:
    """Each two neighbouring words of the runs in ``found``, in the same form."""
    kind = "array<struct<start:int,end:int,match:string,before:string>>"

    def pairs(run: Column, words: Column) -> Column:
        def step(acc: Column, k: Column) -> Column:
            word = F.get(words, k - 1)
            match = F.concat(word, F.lit(" "), F.regexp_replace(F.get(words, k), "[.]$", ""))
            start = run["start"] + acc["at"]
            before = F.right(F.concat(run["before"], F.left(run["match"], acc["at"])), F.lit(BEFORE))
            pair = F.struct(start.alias("start"), (start + F.length(match)).alias("end"), match.alias("match"),
                            before.alias("before"))
            return F.struct((acc["at"] + F.length(word) + 1).alias("at"), F.concat(acc["out"], F.array(pair)).alias("out"))

        first = F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("out"))
        return F.aggregate(F.sequence(F.lit(1), F.size(words) - 1), first, step, lambda acc: acc["out"])

    return F.flatten(F.transform(found, lambda run: let(F.split(run["match"], " "), lambda words: pairs(run, words))))


FINDERS = {
    "email": (EMAIL, "@", None),
    "ip": (IP, "[0-9][.][0-9]", _ip_valid),
    "card": (CARD, CARD, _luhn),
    "phone": (PHONE, "[+][0-9]", _phone_valid),
    "id": (ID, ID, _id_valid),
    "name": (NAME, NAME, None),
}


def _votes(kind: Column, match: Column, before: Column) -> list[Column]:
    """+1 personal, -1 not, 0 no vote, by labeler."""
    yes, no, none = F.lit(1), F.lit(-1), F.lit(0)
    word = F.regexp_extract(match, WORD, 0)
    shape = F.when(kind.isin(*BASE_KINDS) | match.rlike(STRICT), yes).when(
        match.rlike("^[0-9]+$") | match.rlike("^([0-9]+[ .])+[0-9]+$"), no).otherwise(none)
    gazetteer = F.when(word.isin(*GIVEN_NAMES, *TITLES), yes).when(
        (kind == "name") | match.rlike("^[0-9.]+$"), no).otherwise(none)
    context = F.when(before.rlike(CUES), yes).when(before.rlike(COUNTER_CUES), no).otherwise(none)
    around = F.when(before.rlike("[:=] *$"), yes).when(before.rlike("[0-9$€£/#.] *$"), no).otherwise(none)
    return [shape, gazetteer, context, around]


def _described(kind: str, found: Column, valid) -> Column:
    """The valid matches of a kind with votes and features; length and digit share in thirds."""
    kept = F.filter(found, lambda s: valid(s["match"])) if valid else found
    out = F.transform(_neighbours(kept) if kind == "name" else kept, lambda s: F.struct(
        F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
        F.array(*_votes(F.lit(kind), s["match"], s["before"])).alias("votes"),
        F.least(F.length(s["match"]) / 8, F.lit(2)).cast("int").alias("length"),
        (F.length(_digits(s["match"])) * 2 / F.length(s["match"])).cast("int").alias("digits")))
    return F.filter(out, lambda s: F.exists(s["votes"], lambda v: v > 0)) if kind == "name" else out


def find_spans(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and ``spans``: kind, start, end, votes and features of base spans and candidates, in order."""
    rows = with_computed(docs.select(F.col(f"`{key}`").alias("doc_id"),
                                     F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("t")), {"text": F.col("t")})
    t = F.col("text")
    parts = []
    for kind, (pattern, guard, valid) in FINDERS.items():
        parts.append(_described(kind, _found(t, pattern, guard), valid))
    base, more = F.concat(*parts[:4]), F.concat(*parts[4:])
    rows = with_computed(rows.drop("t"), {"base": base, "more": more}).drop("text")
    free = F.filter("more", lambda m: ~F.exists("base", lambda b: (b["start"] < m["end"]) & (m["start"] < b["end"])))
    return with_computed(rows, {"spans": F.concat("base", free)}).select("doc_id", "spans")


def estimate(counts: dict[tuple[int, ...], int]) -> dict[tuple[int, ...], float]:
    """Posterior of a personal span by vote pattern: EM over labelers independent given the truth."""
    right = [0.8] * len(LABELERS)  # chance that a vote cast agrees with the truth
    prior = 0.5
    posterior: dict[tuple[int, ...], float] = {}
    for _ in range(EM_ROUNDS):
        for votes in counts:
            odds = math.log(prior / (1 - prior))
            odds += sum(v * math.log(r / (1 - r)) for v, r in zip(votes, right))
            posterior[votes] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
        total = sum(counts.values())
        prior = min(0.99, max(0.01, sum(n * posterior[v] for v, n in counts.items()) / total))
        for k in range(len(LABELERS)):
            cast = [(v, n) for v, n in counts.items() if v[k]]
            agreed = sum(n * (posterior[v] if v[k] > 0 else 1 - posterior[v]) for v, n in cast)
            # Four agreeing and one differing vote beforehand keep a silent labeler defined.
            right[k] = min(0.99, max(0.01, (agreed + 4) / (sum(n for _, n in cast) + 5)))
    return posterior


def _features(votes, length, digits, is_name) -> list:
    return [*votes, length, digits, is_name]


def fit(rows: list[tuple[tuple[int, ...], int, int, int, int]]) -> list[float]:
    """Weights, bias last, of a logistic classifier on (votes, length, digits, is_name, count) rows."""
    counts: dict[tuple[int, ...], int] = {}
    for votes, _, _, _, n in rows:
        counts[votes] = counts.get(votes, 0) + n
    target = estimate(counts)
    total = sum(counts.values())
    weights = [0.0] * (len(LABELERS) + 4)
    for _ in range(FIT_ROUNDS):
        slope = [RIDGE * w for w in weights]
        for votes, length, digits, is_name, n in rows:
            x = [*_features(votes, length, digits, is_name), 1]
            z = sum(a * b for a, b in zip(weights, x))
            error = (1 / (1 + math.exp(-max(-30.0, min(30.0, z)))) - target[votes]) * n / total
            slope = [s + error * a for s, a in zip(slope, x)]
        weights = [w - RATE * s for w, s in zip(weights, slope)]
    return weights


def train(spans: DataFrame) -> list[float] | None:
    """Classifier weights from all spans of a ``find_spans`` table; None without spans."""
    s = F.col("s")
    patterns = spans.select(F.explode("spans").alias("s")).groupBy(
        *[s["votes"][k].alias(f"v{k}") for k in range(len(LABELERS))],
        s["length"].alias("length"), s["digits"].alias("digits"), (s["kind"] == "name").cast("int").alias("is_name"),
    ).agg(F.count("*").alias("n"))
    rows = [(tuple(r[f"v{k}"] for k in range(len(LABELERS))), r["length"], r["digits"], r["is_name"], r["n"])
            for r in patterns.collect()]
    return fit(sorted(rows)) if rows else None


def label_spans(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and ``spans`` (kind, start, end): base spans and those the trained classifier adds."""
    spans = find_spans(docs, key, text)
    weights = train(spans)

    def sure(s: Column) -> Column:
        if weights is None:
            return s["kind"].isin(*BASE_KINDS)
        values = _features([s["votes"][k] for k in range(len(LABELERS))], s["length"], s["digits"],
                           (s["kind"] == "name").cast("int"))
        score = F.lit(weights[-1])
        for w, value in zip(weights, values):
            score = score + F.lit(w) * value
        return s["kind"].isin(*BASE_KINDS) | (score >= math.log(THRESHOLD / (1 - THRESHOLD)))

    kept = F.transform(F.filter("spans", sure), lambda s: F.struct(
        s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return spans.select("doc_id", kept.alias("spans"))


def span_digest(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


@register("op5_pii_weak_labels")
def op5_pii_weak_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_computed(label_spans(read(spark, sf_dir, "documents")), {"all": F.col("spans")})
    of = lambda kind: F.filter("all", lambda s: s["kind"] == kind)
    base = F.filter("all", lambda s: s["kind"].isin(*BASE_KINDS))
    return rows.select(
        "doc_id", *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in BASE_KINDS],
        F.sha2(span_digest(base), 256).alias("base_sha256"), span_digest(F.col("all")).alias("spans"))
