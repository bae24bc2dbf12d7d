"""Quality by weak supervision: rules vote or abstain, EM learns how far each can be trusted.

A rule votes good (1), bad (-1) or abstains (0) on a text. Each rule has, for good and for bad texts, a
probability to vote good when it votes at all; expectation-maximisation over the counts of vote patterns
estimates these and the share of good texts, over texts that pass two base rules. A text is kept if the posterior probability that it is
good reaches a threshold; one that fails the base is not kept whatever the votes.

All features come from the whole text, by SQL functions alone. Every round of EM is one aggregation over
the vote patterns, at most 3 to the power of the number of rules rows.

Defined results: NULL and blank texts have zero of everything and fail the base; repeated rows get equal
results; an empty table gives an empty table; if no rule votes on a text, its posterior is the prior.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, cut, fresh, words

ROUNDS = 12
#: Where EM starts: the share of good texts, and how often a vote on a good and on a bad text is good.
#: A good text has hardly a fault; a bad one has some, seldom all.
PRIOR, GOOD_START, BAD_START = 0.8, 0.98, 0.5
#: Pseudo-counts that keep the probabilities off 0 and 1.
SMOOTH = 1.0
SYMBOLS = "#*$%&|<>"
_BLANKS = " \t\n\x0b\x0c\r"


def _repeat_words(df: DataFrame, of: str, to: str) -> DataFrame:
    """Add the number of words inside 3-word windows that the text holds twice or more.

    Windows are hashed and sorted with their places; equal neighbours are repeats, and the places of
    repeats, three words each, are then measured without overlap."""
    places, sorted_, repeats = fresh(df, "places", "sorted", "repeats")
    w, n = F.col(f"`{of}`"), F.size(F.col(f"`{of}`"))
    hashes = F.transform(
        F.sequence(F.lit(0), n - 3),
        lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)),
    )
    df = df.withColumn(places, F.when(n >= 4, hashes))
    h = F.col(f"`{places}`")
    some = F.size(F.array_distinct(h)) < F.size(h)
    ordered = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    df = df.withColumn(sorted_, F.when(some, ordered))
    s = F.col(f"`{sorted_}`")
    equal = F.filter(
        s,
        lambda x, i: x["h"].eqNullSafe(F.get(s, i + 1)["h"]) | x["h"].eqNullSafe(F.get(s, i - 1)["h"]),
    )
    df = df.withColumn(repeats, F.sort_array(F.transform(equal, lambda x: x["i"])))
    r = F.col(f"`{repeats}`")
    covered = F.aggregate(
        r,
        F.struct(F.lit(0).cast("long").alias("total"), F.lit(-3).alias("last")),
        lambda a, i: F.struct(
            (a["total"] + F.least(F.lit(3), i - a["last"])).alias("total"), i.alias("last")
        ),
        lambda a: a["total"],
    )
    return df.withColumn(to, F.coalesce(covered, F.lit(0).cast("long"))).drop(places, sorted_, repeats)


def features(docs: DataFrame) -> DataFrame:
    """(doc_id, counts): what base and rules look at."""
    text = F.coalesce(F.col("text"), F.lit(""))
    df = docs.select("doc_id", text.alias("text")).withColumn("words", words(F.col("text")))
    df = _repeat_words(df, "words", "n_repeat_words")
    df = df.withColumn("lines", F.filter(F.split("text", "\n"), lambda x: F.btrim(x, F.lit(_BLANKS)) != ""))

    def without(chars: str) -> Column:
        return F.length(F.translate("text", chars, ""))

    length = F.length("text")
    return df.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        without(_BLANKS).cast("long").alias("word_chars"),
        (length - without(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        F.size("lines").cast("long").alias("n_lines"),
        F.size(F.array_distinct("words")).cast("long").alias("n_distinct"),
        F.regexp_count("text", F.lit(r"\p{Lu}")).cast("long").alias("n_upper"),
        (length - without("!?")).cast("long").alias("n_shouts"),
        F.regexp_count("text", F.lit(rf"[^\p{{L}}{SPACE}]")).cast("long").alias("n_other"),
    )


#: Rule: (name, tested count, out of, bad above or below this percentage, good at or within this one).
#: ``high`` rules find much of it bad, ``low`` rules little. Between the two figures a rule abstains.
RULES = (
    ("symbols", "high", "n_symbols", "word_chars", 3, 1),
    ("other", "high", "n_other", "word_chars", 20, 10),
    ("repeats", "high", "n_repeat_words", "n_words", 30, 15),
    ("distinct", "low", "n_distinct", "n_words", 25, 50),
    ("capitals", "high", "n_upper", "word_chars", 30, 10),
    ("shouting", "high", "n_shouts", "n_words", 25, 5),
    ("lines", "high", "n_dup_lines", "n_lines", 30, 5),
    ("long_words", "high", "word_chars", "n_words", 1200, 900),
)


def votes() -> dict[str, str]:
    """SQL of each rule's vote; texts too short for a percentage to say much get no vote."""
    found = {}
    for name, kind, part, whole, bad, good in RULES:
        above, within = (">", "<=") if kind == "high" else ("<", ">=")
        found[f"v_{name}"] = (
            f"case when n_words < 20 then 0 when 100 * {part} {above} {bad} * {whole} then -1 "
            f"when 100 * {part} {within} {good} * {whole} then 1 else 0 end"
        )
    return found


BASE_FAILED = "n_words < 50 or 100 * n_repeat_words > 50 * n_words"


def _posterior(names: list[str], state: dict[str, float]) -> Column:
    """P(good | votes): the product of the vote probabilities, abstentions left out."""

    def likelihood(kind: str) -> Column:
        terms = [
            F.when(F.col(n) == 1, F.lit(state[f"{kind}_{n}"]))
            .when(F.col(n) == -1, F.lit(1 - state[f"{kind}_{n}"]))
            .otherwise(F.lit(1.0))
            for n in names
        ]
        return reduce(lambda a, b: a * b, terms)

    good = F.lit(state["prior"]) * likelihood("good")
    return good / (good + F.lit(1 - state["prior"]) * likelihood("bad"))


def estimate(patterns: DataFrame, names: list[str], rounds: int = ROUNDS) -> dict[str, float]:
    """EM over (votes…, n): the share of good texts, and P(votes good | good / bad, votes) of each rule."""
    state = {"prior": PRIOR} | {f"good_{n}": GOOD_START for n in names} | {f"bad_{n}": BAD_START for n in names}
    n = F.col("n")
    for _ in range(rounds):
        g = F.col("g")
        sums = [(F.sum(n * g) + SMOOTH) / (F.sum(n) + 2 * SMOOTH)]
        for kind, p in (("good", g), ("bad", 1 - g)):
            for v in names:
                up = F.sum(F.when(F.col(v) == 1, n * p).otherwise(0.0))
                all_ = F.sum(F.when(F.col(v) != 0, n * p).otherwise(0.0))
                sums.append((up + SMOOTH) / (all_ + 2 * SMOOTH))
        row = patterns.withColumn("g", _posterior(names, state)).agg(*sums).first()
        if row[0] is None:
            break
        state = dict(zip(state, row, strict=True))
    return state


def judge(docs: DataFrame, *, least: float = 0.5, rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, counts, votes, base_failed, p_good, kept) of every document."""
    rules = votes()
    found = features(docs)
    found = found.select("*", *(F.expr(sql).alias(n) for n, sql in rules.items()), F.expr(BASE_FAILED).alias("base_failed"))
    found = cut(found)
    # At most 3 ** 8 rows. Texts that the base has judged teach nothing about the others.
    patterns = cut(found.filter(~F.col("base_failed")).groupBy(*rules).agg(F.count("*").cast("double").alias("n")).coalesce(1))
    posterior = _posterior(list(rules), estimate(patterns, list(rules), rounds))
    return found.withColumn("p_good", posterior).withColumn(
        "kept", ~F.col("base_failed") & (F.col("p_good") >= least)
    )


COLUMNS = (
    "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept".split()
)


def oracle(least: float = 0.5, rounds: int = ROUNDS) -> str:
    """DuckDB SQL for the columns of the contract: the same features, votes and rounds."""
    rules = votes()
    blanks = "chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '"
    spec = rf"[^{SPACE}]+"

    def likelihood(kind: str) -> str:
        return " * ".join(
            f"case {n} when 1 then s.{kind}_{n} when -1 then 1 - s.{kind}_{n} else 1.0::double end" for n in rules
        )

    posterior = f"(s.prior * {likelihood('good')}) / (s.prior * {likelihood('good')} + (1 - s.prior) * {likelihood('bad')})"
    start = ", ".join(
        [f"{PRIOR}::double prior"]
        + [f"{GOOD_START}::double good_{n}" for n in rules]
        + [f"{BAD_START}::double bad_{n}" for n in rules]
    )
    steps = [f"s0 as materialized (select {start})"]
    for k in range(rounds):
        sums = [f"(sum(n * g) + {SMOOTH}) / (sum(n) + {2 * SMOOTH}) prior"]
        for kind, p in (("good", "g"), ("bad", "(1 - g)")):
            sums += [
                f"(sum(case when {v} = 1 then n * {p} else 0 end) + {SMOOTH}) / "
                f"(sum(case when {v} <> 0 then n * {p} else 0 end) + {2 * SMOOTH}) {kind}_{v}"
                for v in rules
            ]
        steps.append(
            f"s{k + 1} as materialized (select {', '.join(sums)} from (select p.*, {posterior} g from patterns p, s{k} s))"
        )
    chain = ",\n".join(steps)
    return rf"""
with texts as (select doc_id, coalesce(text, '') text, regexp_extract_all(coalesce(text, ''), '{spec}') w from documents),
windows as (
  select doc_id, unnest(range(1, len(w) - 1)) i, unnest([w[j:j + 2] for j in range(1, len(w) - 1)]) x
  from texts where len(w) >= 3
), repeated as (
  select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, x) c from windows) where c > 1
), covered as (
  select doc_id, count(distinct i + d)::bigint n from repeated, (values (0), (1), (2)) o(d) group by doc_id
), lines as (
  select doc_id, [x for x in string_split(text, chr(10)) if trim(x, {blanks}) <> ''] l from texts
), features as (
  select doc_id, len(w)::bigint n_words, length(translate(text, {blanks}, ''))::bigint word_chars,
    (length(text) - length(translate(text, '{SYMBOLS}', '')))::bigint n_symbols,
    (len(l) - len(list_distinct(l)))::bigint n_dup_lines, coalesce(c.n, 0)::bigint n_repeat_words,
    len(l)::bigint n_lines, len(list_distinct(w))::bigint n_distinct,
    len(regexp_extract_all(text, '\p{{Lu}}'))::bigint n_upper,
    (length(text) - length(translate(text, '!?', '')))::bigint n_shouts,
    len(regexp_extract_all(text, '[^\p{{L}}{SPACE}]'))::bigint n_other
  from texts join lines using (doc_id) left join covered c using (doc_id)
), voted as (
  select *, {", ".join(f"{sql} {n}" for n, sql in rules.items())}, {BASE_FAILED} base_failed from features
), patterns as materialized (select {", ".join(rules)}, count(*)::double n from voted where not base_failed group by all),
{chain}
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and {posterior} >= {least} kept
from voted, s{rounds} s
"""
