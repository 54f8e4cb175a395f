"""URL filters by Bloom filter cascades, in DataFrame and SQL functions only.

A rule is a host and a path prefix, and fits a url of that host or a subdomain whose path starts with the prefix. A url's
candidate keys are each suffix of its host with each prefix of its path that has a rule's path length, so a rule fits if
its key is among them.

A cascade tells listed keys from all other keys of the corpus exactly. Level 0 holds the listed keys; level 1 the other
keys of the corpus that level 0 takes for listed; level 2 the listed keys that level 1 takes; and so on until no key is taken
wrongly. Level 0 is sized so that about as many keys pass it as are listed, the others so that half pass: all levels
together take a fixed number of bits for each listed key (and its logarithm over the corpus' keys), whatever the
corpus' size. Levels are literals in the plan, at most MAX_BITS in all; larger lists are refused, never cut.
A url is judged by looking its keys up; no join is needed.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cueforge.llm.store import Store

MAX_BITS = 1 << 27
#: The rules of the registered query: (verdict, host, path).
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Level:
    """A Bloom filter of `bits` bits with `hashes` positions a key."""

    bits: int
    hashes: int
    seed: int
    words: tuple[int, ...] = ()

    def positions(self, key: str) -> str:
        """SQL: the key's bit positions (double hashing)."""
        a, b = self._hashes(key)
        return f"transform(sequence(0, {self.hashes - 1}), j -> ({a} + cast(j as bigint) * {b}) % {self.bits}L)"

    def _hashes(self, key: str) -> tuple[str, str]:
        return f"pmod(xxhash64({key}, {self.seed}), 2147483648L)", f"(pmod(xxhash64({key}, {self.seed + 1}), 1073741824L) * 2L + 1L)"

    def holds(self, key: str) -> str:
        """SQL: whether all the key's bits are set."""
        words = f"cast(split('{','.join(map(str, self.words))}', ',') as array<bigint>)"
        a, b = self._hashes(key)
        one = lambda j: f"(({a} + {j}L * {b}) % {self.bits}L)"
        tests = [f"(shiftright(element_at({words}, cast(({one(j)}) div 64 + 1 as int)), cast(({one(j)}) % 64 as int)) & 1) = 1" for j in range(self.hashes)]
        return "(" + " and ".join(tests) + ")"


def _level(keys: DataFrame, n: int, share: float, seed: int) -> Level:
    """A filter of n keys (column key) that passes about `share` of all others."""
    hashes = max(1, round(-math.log2(share)))
    bits = 64 * max(1, math.ceil(n * hashes / math.log(2) / 64))
    if bits > MAX_BITS:
        raise ValueError(f"a level of {bits} bits is above the limit of {MAX_BITS}")
    plain = Level(bits, hashes, seed)
    at = keys.select(F.explode(F.expr(plain.positions("key"))).alias("p"))
    words = at.groupBy(F.expr("p div 64").alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p % 64 as int))")).alias("v"))
    full = [0] * (bits // 64)
    for w, v in words.collect():  # at most bits / 64 rows
        full[w] = v
    return Level(bits, hashes, seed, tuple(full))


def cascade(universe: DataFrame, listed: DataFrame, store: Store, name: str) -> list[Level]:
    """The levels that tell the listed keys from the other keys of the universe (both: column key, distinct)."""
    others = universe.join(listed, "key", "left_anti")
    sides, counts = [listed, others], [listed.count(), others.count()]
    levels: list[Level] = []
    if not counts[0]:
        return levels
    share = min(0.5, max(1e-12, math.sqrt(0.5) * counts[0] / max(1, counts[1])))
    while True:
        turn = len(levels)
        levels.append(_level(sides[turn % 2], counts[turn % 2], share if turn == 0 else 0.5, 1000 + 2 * turn))
        passed = sides[1 - turn % 2].where(F.expr(levels[-1].holds("key")))
        sides[1 - turn % 2] = store.save(passed, f"{name}{turn}")
        counts[1 - turn % 2] = sides[1 - turn % 2].count()
        if not counts[1 - turn % 2]:
            return levels


def listed_by(levels: list[Level], key: str) -> str:
    """SQL: whether a key of the universe is listed. The first level that refuses it decides."""
    if not levels:
        return "false"
    cases = " ".join(f"when not {level.holds(key)} then {'true' if i % 2 else 'false'}" for i, level in enumerate(levels))
    return f"(case {cases} else {'true' if len(levels) % 2 else 'false'} end)"


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without `://`."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"^[^?#]*", 0)
    return F.translate(host, _UPPER, _LOWER), path


def keys(host: str, path: str, lengths: list[int]) -> Column:
    """All keys that a rule could fit by: suffixes of the host at dots with path prefixes of these lengths."""
    suffixes = f"transform(sequence(1, size(split({host}, '[.]'))), i -> array_join(slice(split({host}, '[.]'), i, size(split({host}, '[.]'))), '.'))"
    prefixes = f"filter(array({', '.join(f'if(length({path}) >= {n}, substring({path}, 1, {n}), null)' for n in lengths)}), x -> x is not null)"
    return F.expr(f"flatten(transform({suffixes}, s -> transform({prefixes}, p -> concat(s, p))))")


def judged(spark: SparkSession, pages: DataFrame, rules: list[tuple[str, str, str]] | None = None, default: str = "allow") -> DataFrame:
    """(page_id, host, path, rule, verdict) of pages (page_id, url).

    The longest fitting rule decides; without one, rule is null and the verdict is `default`. A null url has empty
    parts and fits no rule with a host; repeated rows are judged alike; an empty table gives no rows.
    """
    rules = RULES if rules is None else rules
    store = Store(spark, "urls")
    lengths = sorted({len(p) for _, _, p in rules}) or [1]
    host, path = parts(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    near = rows.select(F.explode(keys("host", "path", lengths)).alias("key")).distinct()
    near = store.save(near, "universe")
    found = {}
    for verdict in ("allow", "block"):
        own = sorted({h + p for v, h, p in rules if v == verdict})
        listed = spark.range(1).select(F.explode(F.array(*map(F.lit, own)).cast("array<string>")).alias("key"))
        found[verdict] = cascade(near, listed, store, verdict)
    best = F.expr(f"filter(transform(_keys, k -> struct(length(k) as size, case when {listed_by(found['block'], 'k')} then 'block' when {listed_by(found['allow'], 'k')} then 'allow' end as verdict, k as rule)), x -> x.verdict is not null)")
    rows = rows.withColumn("_keys", keys("host", "path", lengths)).withColumn("_best", F.array_max(best))
    return rows.select("page_id", "host", "path", F.col("_best.rule").alias("rule"), F.coalesce("_best.verdict", F.lit(default)).alias("verdict"))


ORACLE = """
with u as (select page_id, coalesce(case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) end, '') as rest from pages),
h as (select page_id, rest, regexp_extract(rest, '^[^/?#]*') as raw from u),
p as (select page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
             regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') as path from h),
r as (select page_id, host, path, case
        when (host = 'example.net' or suffix(host, '.example.net')) and prefix(path, '/en/') then 'example.net/en/'
        when (host = 'example.com' or suffix(host, '.example.com')) and prefix(path, '/de/') then 'example.com/de/'
        when (host = 'org' or suffix(host, '.org')) and prefix(path, '/fr/') then 'org/fr/'
        when (host = 'net' or suffix(host, '.net')) and prefix(path, '/') then 'net/' end as rule from p)
select page_id, host, path, rule, case when rule in ('net/', 'example.com/de/') then 'block' else 'allow' end as verdict from r
"""
