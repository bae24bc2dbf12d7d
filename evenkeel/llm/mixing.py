"""Mix sources to target weights by temperature, and draw the mix in permuted blocks.

A source's weight is its token share to the power of an exponent, normalised. Exponent 1 keeps the shares,
0 gives equal weights; bisection finds the one that meets a target: an entropy (as a part of the
greatest possible) or a limit on how often a source may repeat. The bisection runs as aggregations over
the table of sources, so their number is free.

Drawing: a source is repeated ``repeats`` times its tokens. Whole repetitions (epochs) take every
document. The last, partial epoch goes through the source's blocks (documents of like hash) in an order
permuted by epoch, takes whole blocks while the budget lasts and the documents of the block at its end in
hash order up to the one that meets the budget. Without ``budget`` the mix is the least one that uses
every document, so that the largest source (in repeats the least) is read once.

Tokens are words. Defined results: NULL sources form one source of their own; NULL and blank texts have no
tokens, and a source without any is drawn once; sources of equal size get equal weights, a single source all of
it; repeated rows are each drawn; an empty table gives an empty mix.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE, cut, fresh, quoted

#: Hexadecimal digits of the hash that name a block: at most 16 ** DIGITS blocks per source.
DIGITS = 3
#: Exponents tried in one pass of the bisection; each pass narrows the interval by as much.
_GRID = 32
_PASSES = 6


def _hash(*parts: Column) -> Column:
    return F.md5(F.concat_ws(":", *parts))


def _share_power(alpha: Column) -> Column:
    return F.when(F.col("tokens") > 0, F.pow(F.col("tokens") / F.col("all_tokens"), alpha)).otherwise(0.0)


def _measure(target: str) -> Column:
    """The entropy of the weights as a part of the greatest, or the most repeats of any source."""
    if target == "entropy":
        # H = ln Z - sum(w ln w) / Z over unnormalised weights w.
        w = F.col("w")
        h = F.ln(F.sum(w)) - F.sum(F.when(w > 0, w * F.ln(w)).otherwise(0.0)) / F.sum(w)
        n = F.count(F.when(w > 0, 1))
        return F.when(n > 1, h / F.ln(F.greatest(n, F.lit(2)))).otherwise(1.0)  # one source is as mixed as it can be
    per_token = F.when(F.col("tokens") > 0, F.col("w") / F.col("tokens"))
    return F.max(per_token) / F.min(per_token)


def solve(sources: DataFrame, *, target: str, value: float) -> float:
    """The greatest temperature exponent between 0 and 1, to six digits, that meets the target.

    Both measures fall as the exponent grows: entropy must reach ``value``; repeats must not exceed it."""
    low, high = 0.0, 1.0
    for _ in range(_PASSES):
        step = (high - low) / _GRID
        grid = F.array(*(F.lit(low + step * k) for k in range(_GRID + 1)))
        tried = sources.select("tokens", "all_tokens", F.posexplode(grid).alias("k", "alpha"))
        tried = tried.withColumn("w", _share_power(F.col("alpha")))
        # One row per grid point.
        found = {r[0]: r[1] for r in tried.groupBy("k").agg(_measure(target)).collect()}
        if not found or found[0] is None:
            return 1.0
        if target == "entropy":
            good = [k for k in found if found[k] >= value]
            k = max(good, default=0)
            low, high = low + step * k, low + step * min(k + 1, _GRID)
        else:
            good = [k for k in found if found[k] <= value]
            k = min(good, default=_GRID)
            low, high = low + step * max(k - 1, 0), low + step * k
        if low == high:
            break
    return round(low if target == "entropy" else high, 6)


def weigh(docs: DataFrame, *, target: str, value: float, budget: int | None = None) -> DataFrame:
    """(source, tokens, weight, repeats, wanted): how much of each source the mix takes."""
    totals = docs.groupBy("source_").agg(F.sum("tokens_").alias("tokens"))
    totals = cut(totals)
    everything = totals.agg(F.sum("tokens")).first()[0] or 0
    sources = totals.withColumn("all_tokens", F.lit(everything))
    alpha = F.lit(solve(sources, target=target, value=value))
    w = sources.withColumn("w", _share_power(alpha))
    raw = F.when(F.col("tokens") > 0, F.col("w") / F.col("tokens"))
    z, least = w.agg(F.sum("w"), F.min(raw)).first()
    repeats = raw / F.lit(least) if budget is None else F.lit(float(budget)) * raw / F.lit(z)
    repeats = F.coalesce(F.round(repeats, 6), F.lit(1.0))
    weight = F.round(F.col("w") / F.lit(z), 9) if z else F.lit(0.0)
    found = w.select("source_", "tokens", weight.alias("weight"), repeats.alias("repeats"))
    return found.withColumn("wanted", F.round(F.col("repeats") * F.col("tokens")).cast("long"))


def mix(
    docs: DataFrame,
    *,
    target: str = "repeats",
    value: float = 4.0,
    budget: int | None = None,
    share: float | None = None,
) -> DataFrame:
    """The documents drawn, one row per draw, with n_tokens, epoch, block and draw_order (or free names).

    ``budget`` is a number of tokens, ``share`` one as a part of all tokens. Sorting by epoch and draw_order gives the permuted sequence."""
    if target not in ("repeats", "entropy"):
        raise ValueError(f"unknown target {target!r}")
    tokens = F.regexp_count(F.coalesce(F.col("text"), F.lit("")), F.lit(f"[^{SPACE}]+")).cast("long")
    source = F.coalesce(F.col("source").cast("string"), F.lit("\0"))
    hashed = _hash(source, F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    light = docs.select(source.alias("source_"), hashed.alias("hash_"), tokens.alias("tokens_"))
    light = cut(light.withColumn("block_", F.substring("hash_", 1, DIGITS)))
    if share is not None:
        if budget is not None:
            raise ValueError("give a budget or a share, not both")
        budget = math.floor(share * (light.agg(F.sum("tokens_")).first()[0] or 0))
    drawn = _draws(light, weigh(light, target=target, value=value, budget=budget))

    n_tokens, epoch, block, rank = names = fresh(docs, "n_tokens", "epoch", "block", "draw_order")
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    rows = docs.select(row, source.alias("source_"), hashed.alias("hash_"), tokens.alias("tokens_"))
    rows = rows.withColumn("block_", F.substring("hash_", 1, DIGITS)).join(drawn, ["source_", "block_"])
    times = F.col("epochs") + F.when(F.col("hash_") <= F.col("cutoff"), 1).otherwise(0)
    rows = rows.filter(times > 0).withColumn("epoch_", F.explode(F.sequence(F.lit(0), times - 1)))
    permuted = _hash(F.col("source_"), F.col("block_"), F.col("epoch_").cast("string"))
    return rows.select(
        "row.*", F.col("tokens_").alias(n_tokens), F.col("epoch_").alias(epoch),
        F.col("block_").alias(block), F.concat(permuted, F.lit("-"), F.col("hash_")).alias(rank),
    ).select(*quoted(docs.columns), *quoted(names))


def _draws(light: DataFrame, sources: DataFrame) -> DataFrame:
    """(source_, block_, epochs, cutoff): whole epochs of a block, and the last hash its partial epoch takes."""
    some = F.col("tokens") > 0
    plan = sources.select(
        "source_",
        F.when(some, F.floor(F.col("wanted") / F.col("tokens"))).otherwise(1).cast("int").alias("epochs"),
        F.when(some, F.col("wanted") % F.col("tokens")).otherwise(0).alias("rest"),
    )
    # At most 16 ** DIGITS rows per source, whatever its size.
    blocks = light.groupBy("source_", "block_").agg(F.sum("tokens_").alias("block_tokens")).join(plan, "source_")
    rank = _hash(F.col("source_"), F.col("block_"), F.col("epochs").cast("string"))
    order = Window.partitionBy("source_").orderBy(rank)
    before = F.sum("block_tokens").over(order) - F.col("block_tokens")
    blocks = cut(blocks.withColumn("room", F.col("rest") - before))
    # The one block per source where the budget ends goes document by document.
    edge = blocks.filter("room > 0 and room < block_tokens").select("source_", "block_", "room")
    keys = ["source_", "block_"]
    within = Window.partitionBy(*keys).orderBy("hash_")
    last = light.join(edge, keys).groupBy(*keys, "hash_", "room").agg(F.sum("tokens_").alias("t"))
    last = last.withColumn("before", F.sum("t").over(within) - F.col("t")).filter("before < room")
    last = last.groupBy(*keys).agg(F.max("hash_").alias("last"))
    # "g" follows every hexadecimal digit.
    whole = F.when((F.col("room") > 0) & (F.col("room") >= F.col("block_tokens")), F.lit("g"))
    joined = blocks.join(last, keys, "left")
    return joined.select(*keys, "epochs", F.coalesce(whole, F.col("last")).alias("cutoff"))


def oracle(value: float = 4.0, share: float | None = None) -> str:
    """DuckDB SQL for (doc_id, source, n_tokens, epoch, block, draw_order) under a limit on repeats."""
    # How often a source is read: as often as its weight asks for beside the least one, or as the budget does.
    repeats = "r / min(r) over ()" if share is None else f"floor({share}::double * any_value(total) over ()) * r / sum(r * t) over ()"
    return rf"""
with recursive light as (
  select doc_id, source, coalesce(source, chr(0)) s, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+'))::bigint t,
    md5(coalesce(source, chr(0)) || ':' || doc_id) h from documents
), src as (select s, sum(t)::bigint t, sum(sum(t)) over ()::double total from light group by s),
steps(k, low, high) as (
  select 0, 0.0::double, 1.0::double
  union all
  select k + 1, case when m <= {value} then low else (low + high) / 2 end,
    case when m <= {value} then (low + high) / 2 else high end
  from (select k, low, high,
    (select max(pow(t / total, (low + high) / 2) / t) / min(pow(t / total, (low + high) / 2) / t) from src where t > 0) m
    from steps where k < 60)
), answer as (
  select case when (select max(1.0 / t) / min(1.0 / t) from src where t > 0) <= {value} then 0.0
    else round((select high from steps where k = 60), 6) end a
), weighed as (select s, t, case when t > 0 then pow(t / total, (select a from answer)) / t end r, total from src),
plan as (
  select s, t, case when t > 0 then (round(round({repeats}, 6) * t)::bigint // t)::int else 1 end epochs,
    case when t > 0 then round(round({repeats}, 6) * t)::bigint % t else 0 end rest from weighed
), hashed as (select *, substr(h, 1, {DIGITS}) b from light),
blocks as (
  select s, b, rest, sum(t) bt, md5(s || ':' || b || ':' || epochs) o
  from hashed join (select s, epochs, rest from plan where rest > 0) using (s) group by s, b, rest, epochs
), placed as (select s, b, rest, bt, sum(bt) over (partition by s order by o) - bt before_b from blocks),
inside as (
  select h.doc_id, rest - before_b room, bt,
    sum(h.t) over (partition by h.s, h.b order by h.h rows unbounded preceding) - h.t before_d
  from hashed h join placed p on h.s = p.s and h.b = p.b where before_b < rest
), more as (select doc_id from inside where room >= bt or before_d < room),
counted as (
  select h.*, p.epochs + (h.doc_id in (select doc_id from more))::int n from hashed h join plan p using (s)
), drawn as (select *, unnest(range(n))::int epoch from counted where n > 0)
select doc_id, source, t n_tokens, epoch, b block, md5(s || ':' || b || ':' || epoch) || '-' || h draw_order from drawn
"""
