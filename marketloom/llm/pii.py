"""Operator 6: personal data by bootstrapped contextual extraction."""

from __future__ import annotations

import bisect
import hashlib
import re
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import releasing, table, written

KINDS = ("email", "ip", "card", "phone")
#: Rows whose spans a task holds as Python values at once.
BLOCK = 512
LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
NOT_LOCAL = re.compile(r"[^A-Za-z0-9._%+-]")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: What may be an identifier that the plain patterns don't know: a name at a host, spelled out or masked, and groups of
#: digits or mask signs with separators; both may run over several tokens.
AT = re.compile(r"(?<![\w.%+*-])[\w.%+*-]++\x20?(?:@|[(\[]at[)\]])\x20?\w[\w*-]*+(?:(?:\.|\x20?[(\[]dot[)\]]\x20?)[\w*-]++)*+")
GROUP = r"(?:[0-9]++|[xX*#]{2,}+|[xX*](?![A-Za-z0-9]))++"
NUMBER = re.compile(rf"(?<![\w@.,$])[+(]{{0,2}}{GROUP}(?:[\x20()./-]{{1,3}}+{GROUP})*+")
IP6 = re.compile(r"(?<![\w:.])[0-9A-Fa-f]{0,4}(?::[0-9A-Fa-f]{0,4}){2,7}(?![\w:])")
SIGN = re.compile(r"[0-9xX*#]")
QUAD = re.compile(r"(?:[0-9]{1,3}|[xX*#]{1,3})(?:\.(?:[0-9]{1,3}|[xX*#]{1,3})){3}\Z")
DATE = re.compile(r"(?:(?:19|20)[0-9]{2}([-/.])[0-9]{1,2}\1[0-9]{1,2}|[0-9]{1,2}([-/.])[0-9]{1,2}\2(?:19|20)[0-9]{2})(?![0-9])")
SPACE = "\x20\t\n\x0b\x0c\r"
TRIM = ".,;:!?\"'()[]{}<>|"


def emails(text: str):
    at, end = text.find("@"), 0
    while at >= 0:
        lo = at
        while lo > end and text[lo - 1].isascii() and (text[lo - 1].isalnum() or text[lo - 1] in "._%+-"):
            lo -= 1
        found = lo < at and DOMAIN.match(text, at + 1)
        if found:
            yield lo, found.end()
            end = found.end()
        else:
            end = max(end, at + 1) if lo == at else end
        at = text.find("@", max(at + 1, end))


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = ord(d) - 48
        total += v if k % 2 == 0 else v * 2 - 9 * (v > 4)
    return total % 10 == 0


def base_spans(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """The plain spans, (kind, start, end) by kind and start, in code points; and what failed as a kind.

    Linear in the text's length. Long digit runs that are no card only by their length don't count as failed.
    """
    out, failed = [("email", s, e) for s, e in emails(text)], []
    for m in IP.finditer(text):
        good = all(len(p.lstrip("0")) <= 3 and int(p[-9:]) <= 255 for p in m[0].split("."))
        (out if good else failed).append(("ip", m.start(), m.end()))
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19:
            (out if luhn(digits) else failed).append(("card", m.start(), m.end()))
    for m in PHONE.finditer(text):
        good = 9 <= sum("0" <= c <= "9" for c in m[0]) <= 15
        (out if good else failed).append(("phone", m.start(), m.end()))
    return out, failed


def shape(token: str) -> str:
    """What an identifier looks like, without lengths, prefixes and separators: a name at a host (@), an address (q), a short (n) or long (N) number; empty if none of these."""
    if "@" in token or AT.match(token):
        return "@"
    if QUAD.match(token) or IP6.fullmatch(token) and ("::" in token or token.count(":") == 7):
        return "q"
    signs = SIGN.findall(token)
    if DATE.match(token) or not 7 <= len(signs) <= 19 or sum(c.isdigit() for c in signs) < 4:
        return ""
    return "N" if len(signs) >= 13 else "n"


def seed_shape(kind: str, token: str) -> str:
    return {"email": "@", "ip": "q"}.get(kind) or ("N" if sum("0" <= c <= "9" for c in token) >= 13 else "n")


def plain_word(word: str) -> str:
    return re.sub(r"[0-9]", "#", word.lower().strip(TRIM))


class Bounds(NamedTuple):
    """What counts as identifier-like and as context, in code points. Base spans and the text itself know no bound."""

    #: An identifier beyond the base spans is at least and at most so long.
    shortest: int = 6
    longest: int = 80
    #: So far from a span its context word begins or ends, and of a longer word the nearest so many count.
    reach: int = 64
    word: int = 40


def before(text: str, start: int, bounds: Bounds = Bounds()) -> str:
    """The word before a place, lower-cased, its digits and outer punctuation gone; empty at a text's start."""
    left = text[max(0, start - bounds.reach) : start].rstrip(SPACE + TRIM)
    return plain_word(re.split(f"[{SPACE}]", left)[-1][-bounds.word :])


def after(text: str, end: int, bounds: Bounds = Bounds()) -> str:
    """The word after a place, as before() has it; empty at a text's end."""
    right = text[end : end + bounds.reach].lstrip(SPACE + TRIM)
    return plain_word(re.split(f"[{SPACE}]", right, maxsplit=1)[0][: bounds.word])


def candidates(text: str, own: list[tuple[str, int, int]], failed: list[tuple[str, int, int]], bounds: Bounds = Bounds()):
    """What is shaped like an identifier between the base spans: (start, end, shape).

    It touches no span that failed as a card or an address, and is more than what failed as a phone.
    """
    covered = sorted((s, e) for k, s, e in [*own, *(x for x in failed if x[0] != "phone")])
    phones = [(s, e) for k, s, e in failed if k == "phone"]
    at = 0
    for s, e in [*covered, (len(text), len(text))]:
        taken = []
        for pattern in (AT, IP6, NUMBER) if s > at else ():
            found = []
            for m in pattern.finditer(text, at, s):
                lo, hi = m.span()
                if pattern is NUMBER and hi < len(text) and (text[hi].isalnum() or text[hi] in "@_"):
                    # a number that runs on into a word loses its last group
                    hi = lo + len(text[lo:hi].rstrip("0123456789xX*#"))
                hi = lo + len(text[lo:hi].rstrip(TRIM + "\x20/-+"))
                lo += text[lo:hi].startswith("(") and ")" not in text[lo:hi]
                kind = shape(text[lo:hi]) if bounds.shortest <= hi - lo <= bounds.longest else ""
                if kind and not meets(taken, lo, hi) and not within(phones, lo, hi):
                    found.append((lo, hi))
                    yield lo, hi, kind
            taken = sorted(taken + found)
        at = max(at, e)


def within(spans: list[tuple[int, int]], lo: int, hi: int) -> bool:
    """Whether one of the spans, in order and apart from each other, holds (lo, hi)."""
    k = bisect.bisect_right(spans, (lo, 1 << 60))
    return k > 0 and spans[k - 1][1] >= hi


def meets(spans: list[tuple[int, int]], lo: int, hi: int) -> bool:
    k = bisect.bisect_left(spans, (hi, -1))
    return k > 0 and spans[k - 1][1] > lo


SCAN = "spans array<struct<kind:string,start:int,end:int>>, seen array<struct<kind:string,start:int,end:int,before:string,after:string,shape:string,instance:long>>"


def instance(s: str) -> int:
    return int.from_bytes(hashlib.blake2b(s.encode("utf-8", "replace"), digest_size=8).digest(), "big", signed=True)


def marked(text: str, bounds: Bounds = Bounds()) -> tuple[list, list]:
    """A text's base spans, and all that is identifier-like: (kind or None, start, end, before, after, shape, instance)."""
    own, failed = base_spans(text)
    found = [*((k, s, e, seed_shape(k, text[s:e])) for k, s, e in own), *((None, *x) for x in candidates(text, own, failed, bounds))]
    return own, [(k, s, e, before(text, s, bounds), after(text, e, bounds), x, instance(text[s:e])) for k, s, e, x in found]


def scan(docs: DataFrame, bounds: Bounds = Bounds()) -> DataFrame:
    """docs' columns with the base spans and, under seen, everything identifier-like with the words beside it."""
    fields = [f for f in docs.schema if f.name not in ("spans", "seen", "_text")]
    item = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
    more = pa.struct([*item, ("before", pa.string()), ("after", pa.string()), ("shape", pa.string()), ("instance", pa.int64())])

    names = ("kind", "start", "end", "before", "after", "shape", "instance")

    def run(batches):
        for batch in batches:
            whole = pa.Table.from_batches([batch])
            for lo in range(0, len(whole), BLOCK):
                t, spans, seen = whole.slice(lo, BLOCK), [], []
                for text in t["_text"]:
                    own, all_ = marked(text.as_py() or "", bounds)
                    spans.append([dict(zip(names, x)) for x in own])
                    seen.append([dict(zip(names, x)) for x in all_])
                t = t.drop_columns(["_text"]).append_column("spans", pa.array(spans, pa.list_(item))).append_column("seen", pa.array(seen, pa.list_(more)))
                yield from t.to_batches()

    return docs.select(*(f.name for f in fields), F.col("text").cast("string").alias("_text")).mapInArrow(releasing(run), ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", " + SCAN)


PATTERN = ["side", "context", "shape"]


def with_patterns(seen: DataFrame) -> DataFrame:
    """A row for each pattern of each row of seen: a shape with the word before, with both words, or with the word after."""
    both = F.when((F.col("before") != "") & (F.col("after") != ""), F.concat_ws(" ", "before", "after")).otherwise("")
    sides = F.array(*(F.struct(F.lit(k).alias("side"), c.alias("context")) for k, c in (("l", F.col("before")), ("b", both), ("r", F.col("after")))))
    return seen.withColumn("_p", F.explode(F.filter(sides, lambda x: x["context"] != ""))).withColumns({"side": F.col("_p.side"), "context": F.col("_p.context")}).drop("_p")


def confident(seen: DataFrame, rounds: int = 4, least: float = 0.6, support: int = 3, trust: float = 0.8) -> DataFrame:
    """Patterns that may be trusted, from seen (kind or null, before, after, shape, instance): side, context, shape, found, p.

    A pattern is a shape with the words beside it (see with_patterns), joined with its distinct instances to a graph. Instances of a base kind
    are seeds of score 1. In each round a pattern scores the mean of its instances' scores (0: not reached yet) and is
    trusted with at least `support` distinct seeds, all of one kind, and a score of at least `least`; the word after alone only
    where its seeds stand after at least `support` words, else it is the word before that tells. Trusted patterns reach
    instances: these score the noisy or of their patterns, and with at least `trust` and one kind only they are seeds of the next
    round, whose patterns so may stand on seeds that no base pattern knows. The last round's trusted patterns are returned.
    """
    edges = with_patterns(seen).groupBy(*PATTERN, "instance").agg(F.max("kind").alias("kind"), F.min("before").alias("before"))
    edges = written(edges, "edges")
    base = edges.where("kind is not null").groupBy("instance").agg(F.max("kind").alias("label"), F.lit(1.0).alias("score"))
    known = base
    for k in range(rounds):
        linked = edges.join(known, "instance", "left")
        seed = F.col("label").isNotNull()
        pattern = linked.groupBy(*PATTERN).agg(
            F.avg(F.coalesce("score", F.lit(0.0))).alias("p"), F.count("label").alias("n"), F.min("label").alias("one"), F.max("label").alias("found"),
            F.count_distinct(F.when(seed, F.col("before"))).alias("n_before"),
        )
        pattern = pattern.where((F.col("n") >= support) & (F.col("one") == F.col("found")) & ((F.col("side") != "r") | (F.col("n_before") >= support)) & (F.col("p") >= least))
        pattern = written(pattern.select(*PATTERN, "found", "p"), "patterns")
        if k < rounds - 1:
            reached = edges.where("kind is null").join(pattern, PATTERN).groupBy("instance")
            reached = reached.agg((1 - F.exp(F.sum(F.ln(F.greatest(1 - F.col("p"), F.lit(1e-6)))))).alias("score"), F.min("found").alias("one"), F.max("found").alias("label"))
            label = F.when((F.col("score") >= trust) & (F.col("one") == F.col("label")), F.col("label"))
            known = written(base.union(reached.select("instance", label.alias("label"), "score").join(base, "instance", "left_anti")), "known")
    return pattern


def detect(docs: DataFrame, rounds: int = 4, least: float = 0.6, support: int = 3, trust: float = 0.8, bounds: Bounds = Bounds()) -> DataFrame:
    """Personal data of docs (doc_id, text): docs' columns but text, base and spans (arrays of kind, start, end).

    Base spans come from the plain patterns; the bootstrapped patterns (see confident) add what stands in a
    trusted pattern's context with its shape and touches no base span (see candidates). Null texts are empty; rows with
    the same doc_id are each a row of their own; an empty table gives none; columns named base, spans, seen, new, _row or _text are left out.
    """
    kept = [c for c in docs.columns if c not in ("text", "spans", "seen", "base", "new", "_row", "_text")]
    found = written(scan(docs.select(*kept, "text"), bounds).drop("text").withColumn("_row", F.monotonically_increasing_id()), "scanned")
    seen = found.select("_row", F.explode("seen").alias("s")).select("_row", "s.*")
    patterns = confident(seen, rounds, least, support, trust)
    new = with_patterns(seen.where("kind is null")).join(patterns, PATTERN)
    new = new.groupBy("_row", "start", "end").agg(F.max_by("found", F.struct("p", "side", "found")).alias("found"))
    new = new.groupBy("_row").agg(F.collect_list(F.struct(F.col("found").alias("kind"), "start", "end")).alias("new"))
    place = F.array(*(F.lit(k) for k in KINDS))

    def ordered(spans):
        keyed = F.transform(spans, lambda x: F.struct(F.array_position(place, x["kind"]).alias("k"), x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind")))
        return F.transform(F.array_sort(keyed), lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end")))

    rows = found.drop("seen").withColumnRenamed("spans", "base").join(new, "_row", "left")
    empty = F.expr("cast(array() as array<struct<kind:string,start:int,end:int>>)")
    return rows.withColumn("spans", ordered(F.concat("base", F.coalesce("new", empty)))).withColumn("base", ordered(F.col("base"))).drop("new", "_row")


def joined(spans: str):
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = detect(table(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = [F.expr(f"cast(size(filter(base, x -> x.kind = '{k}')) as bigint)").alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"))
