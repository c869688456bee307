"""Conversation structure repair: cheapest edits that give every conversation a legal order of roles."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm.common import documents, ranked, stored

BLANK = " \t\n\x0b\f\r"
SEGMENT = 4096  # rows of a conversation that one value holds
DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3
FAR = 1 << 60
# States of the legal order: nothing yet, after system, after user, after assistant.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
NEXT = (USER, USER, ASSISTANT, USER)  # what an inserted or reroled row makes of a state
KEEPS = {"s": {EMPTY: SYSTEM}, "u": {EMPTY: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
LEGAL_PAIRS = {"su", "ua", "au"}
NAMES = {USER: "user", ASSISTANT: "assistant"}
GONE = "x"  # symbol of a row that must be deleted; else the initial (o for others), upper case if truncated


def damaged(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) with the damage their CRC-32 of conv_id:turn asks for; nulls of role and text,
    and of ids within the key, are one space."""
    space = F.lit(" ")
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")])
    kind = F.crc32(F.encode(key, "UTF-8")) % 20
    rows = rows.select("conv_id", "turn", F.coalesce("role", space).alias("role"),
                       F.coalesce("text", space).alias("text"), kind.alias("kind")).filter("kind > 0")
    text = (F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", ""))
            .otherwise(F.col("text")))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    rows = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"),
                       F.when(F.col("kind") == 3, 2).otherwise(1).alias("times"))
    return rows.select("conv_id", "turn", "role", "text", F.explode(F.sequence(F.lit(1), "times")).alias("again"))


def _same(*columns: str) -> Column:
    """Null-safe equality of columns of the left side with those named `of_...` of the right."""
    out = F.lit(True)
    for c in columns:
        out = out & F.col(c).eqNullSafe(F.col(f"of_{c}"))
    return out


def _right(df: DataFrame, *keys: str) -> DataFrame:
    return df.withColumnsRenamed({k: f"of_{k}" for k in keys})


# ---- shortest edits ----

def _plus(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Min-plus product."""
    return np.minimum((a[:, :, None] + b[None, :, :]).min(axis=1), FAR)


def _inserts() -> np.ndarray:
    step = np.full((4, 4), FAR)
    for state in range(4):
        step[state, state], step[state, NEXT[state]] = 0, INSERT
    return _plus(step, step)  # two inserts lead everywhere that any number leads, at least cost


INSERTS = _inserts()
ACCEPT = np.minimum(INSERTS + np.array([0, FAR, FAR, 0]), FAR).min(axis=1)


def _choices(symbol: str, state: int) -> Iterator[tuple[str, int, int]]:
    """(letter, cost, next state) of the edits of one row, in ASCII order of letters."""
    yield "D", DELETE, state
    if symbol != GONE:
        extra = TRUNCATED * symbol.isupper()
        kept = KEEPS.get(symbol.lower(), {}).get(state)
        if kept is not None:
            yield "K", extra, kept
        yield "R", REROLE + extra, NEXT[state]


@lru_cache(maxsize=4096)
def power(symbol: str, exponent: int) -> np.ndarray:
    """Least cost from state to state over 2^exponent rows of a symbol, with inserts before each."""
    if exponent:
        half = power(symbol, exponent - 1)
        return _plus(half, half)
    row = np.full((4, 4), FAR)
    for state in range(4):
        for _, cost, after in _choices(symbol, state):
            row[state, after] = min(row[state, after], cost)
    return _plus(INSERTS, row)


def runs(symbols: str) -> list[tuple[str, int]]:
    return [(symbol, len(list(same))) for symbol, same in groupby(symbols)]


@lru_cache(maxsize=100_000)
def transition(symbols: str) -> np.ndarray:
    """Least cost from state to state over a segment: one product per set bit of each run's length."""
    total = np.where(np.eye(4, dtype=bool), 0, FAR)
    for symbol, length in runs(symbols):
        for bit in range(length.bit_length()):
            if length >> bit & 1:
                total = _plus(total, power(symbol, bit))
    return total


def before(symbols: str, ahead: np.ndarray) -> np.ndarray:
    """Least cost to the end from each state before a segment, given that behind it."""
    return np.minimum((transition(symbols) + ahead).min(axis=1), FAR)


@lru_cache(maxsize=100_000)
def _unrolled(symbols: str, ahead: tuple[int, ...], last: bool) -> tuple[tuple[tuple[str, ...], int], ...]:
    steps = [np.array(ahead)]
    for symbol, length in reversed(runs(symbols)):
        for _ in range(length):
            steps.append(np.minimum((power(symbol, 0) + steps[-1]).min(axis=1), FAR))
    costs = [s.tolist() for s in reversed(steps)]
    return tuple(_walk(symbols, costs, start, last) for start in range(4))


def _walk(symbols: str, costs: list[list[int]], state: int, last: bool) -> tuple[tuple[str, ...], int]:
    """(letters of each row, state behind): the cheapest way, at each step by its least letter.

    Letters fix the states, since what is inserted or reroled is what the order wants next, and no cheapest
    way is the beginning of another, so the least letter at each step gives the least word. Inserts before
    a row belong to it, those at the very end to the last row.
    """
    edits = []
    for at, symbol in enumerate(symbols):
        word, done = "", False
        while not done:
            options = [(letter, cost + costs[at + 1][after], after, True)
                       for letter, cost, after in _choices(symbol, state)]
            options.append(("I", INSERT + costs[at][NEXT[state]], NEXT[state], False))
            least = min((cost, letter, after, stop) for letter, cost, after, stop in options)
            word, state, done = word + least[1], least[2], least[3]
        edits.append(word)
    if last:
        while state not in (EMPTY, ASSISTANT):
            edits[-1], state = edits[-1] + "I", NEXT[state]
    return tuple(edits), state


def unrolled(symbols: str, ahead: np.ndarray, last: bool) -> tuple[tuple[tuple[str, ...], int], ...]:
    """From each state before a segment: the letters of each row and the state behind."""
    return _unrolled(symbols, tuple(int(x) for x in ahead), last)


# ---- jobs ----

def faults(placed: DataFrame) -> DataFrame:
    """(conv_id, place, turn, initial, fault) from placed rows; fault is blank, duplicate, truncated or ''.

    A role and text are seen earlier if their least place in the conversation is another one: an
    aggregate that combines before the shuffle, joined on a key that occurs once on its side.
    """
    end = F.rtrim(F.col("text"), F.lit(BLANK))
    rows = placed.select(
        "conv_id", "place", "turn", F.left("role", F.lit(1)).alias("initial"),
        F.unhex(F.md5(F.to_json(F.struct("role", "text")))).alias("key"),
        F.when(end == "", "blank").when(F.right(end, F.lit(1)).isin(".", "!", "?"), "")
        .otherwise("truncated").alias("own"))
    first = rows.groupBy("conv_id", "key").agg(F.min("place").alias("of_place"))
    rows = rows.join(_right(first, "conv_id").drop("key"), _same("conv_id", "place"), "left")
    repeated = F.col("of_place").isNull() & (F.col("own") != "blank")
    return rows.select("conv_id", "place", "turn", "initial", F.when(repeated, "duplicate").otherwise(
        F.col("own")).alias("fault"))


def segments(rows: DataFrame, size: int = SEGMENT) -> DataFrame:
    """One row per `size` rows of a conversation: symbols and initials in order, and what reports add up."""
    initial = F.when(F.col("initial").isin("s", "u", "a"), F.col("initial")).otherwise("o")
    symbol = (F.when(F.col("fault").isin("blank", "duplicate"), GONE)
              .when(F.col("fault") == "truncated", F.upper(initial)).otherwise(initial))
    cells = F.sort_array(F.collect_list(F.struct("place", initial.alias("i"), symbol.alias("s"), "turn")))
    counts = [F.sum((F.col("fault") == name).cast("long")).alias(name)
              for name in ("blank", "duplicate", "truncated")]
    out = rows.groupBy("conv_id", F.floor(F.col("place") / size).alias("segment")).agg(cells.alias("cells"), *counts)
    turns = F.filter("cells.turn", lambda t: t.isNotNull())
    return out.select("conv_id", "segment", "blank", "duplicate", "truncated",
                      F.array_join("cells.i", "").alias("initials"), F.array_join("cells.s", "").alias("symbols"),
                      F.array_min(turns).alias("low"), F.array_max(turns).alias("high"),
                      F.size(F.array_distinct(turns)).cast("long").alias("turns"))


def _illegal(initials: str) -> int:
    return sum(a + b not in LEGAL_PAIRS for a, b in zip(initials, initials[1:], strict=False))


def _summaries(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Transition and illegal pairs of each segment."""
    for frame in frames:
        yield frame.assign(cost=[transition(s).ravel().tolist() for s in frame["symbols"]],
                           illegal=[_illegal(i) for i in frame["initials"]],
                           first=frame["initials"].str[:1], final=frame["initials"].str[-1:]).drop(columns="initials")


_SUMMARY = ("conv_id long, segment long, blank long, duplicate long, truncated long, symbols string, low long, "
            "high long, turns long, cost array<long>, illegal long, first string, final string")


def _chain(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per conversation the cost behind each segment and what adds up, from one small row per segment."""
    for frame in frames:
        rows = []
        for conv_id, parts in zip(frame["conv_id"], frame["parts"], strict=True):
            ahead, at = [ACCEPT], np.array([0])
            for part in reversed(parts[1:]):
                ahead.append(np.minimum((np.array(part["cost"]).reshape(4, 4) + ahead[-1]).min(axis=1), FAR))
            at = np.minimum((np.array(parts[0]["cost"]).reshape(4, 4) + ahead[-1]).min(axis=1), FAR)
            pairs = list(zip(parts, parts[1:], strict=False))
            illegal = sum(p["illegal"] for p in parts) + sum(
                a["final"] + b["first"] not in LEGAL_PAIRS for a, b in pairs)
            known = [p for p in parts if p["low"] is not None]
            distinct = sum(p["turns"] for p in parts) - sum(
                a["high"] == b["low"] for a, b in zip(known, known[1:], strict=False))
            gaps = max(p["high"] for p in known) - known[0]["low"] + 1 - distinct if known else 0
            rows.append((conv_id, int(gaps), int(illegal), int(at[EMPTY]),
                         [a.tolist() for a in reversed(ahead)]))
        out = pd.DataFrame(rows, columns=["conv_id", "gaps", "illegal", "cost", "ahead"])
        yield out.astype({"conv_id": "Int64"})


def _unroll(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        ways = [unrolled(s, a, bool(last)) for s, a, last in zip(
            frame["symbols"], frame["ahead"], frame["last"], strict=True)]
        yield frame[["conv_id", "segment"]].assign(
            edits=[[list(edits) for edits, _ in w] for w in ways], behind=[[state for _, state in w] for w in ways])


def _starts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The state before each segment, following the states behind the earlier ones."""
    for frame in frames:
        starts = []
        for parts in frame["parts"]:
            states = [EMPTY]
            for part in parts[:-1]:
                states.append(int(part["behind"][states[-1]]))
            starts.append(states)
        yield frame[["conv_id"]].assign(starts=starts)


def _digest(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """SHA-256 of each conversation's repaired lines; rows arrive in order, so one hash is open at a time."""
    conv, state, digest, lines = None, EMPTY, None, 0

    def add(line: str) -> None:
        nonlocal lines
        digest.update(("\n" + line if lines else line).encode())
        lines += 1

    for frame in frames:
        done = []
        ids = [None if missing else i for i, missing in zip(frame["conv_id"], frame["conv_id"].isna(), strict=True)]
        for conv_id, place, role, text, edit in zip(ids, frame["place"], frame["role"], frame["text"],
                                                    frame["edit"], strict=True):
            if digest is None or place == 0:
                if digest is not None:
                    done.append((conv, digest.hexdigest()))
                conv, state, digest, lines = conv_id, EMPTY, hashlib.sha256(), 0
            for letter in edit:
                if letter in "IR":
                    state = NEXT[state]
                    add(f"{NAMES[state]}:{text if letter == 'R' else ''}")
                elif letter == "K":
                    state = KEEPS[role[:1]][state]
                    add(f"{role}:{text}")
        yield pd.DataFrame(done, columns=["conv_id", "repaired_sha256"]).astype({"conv_id": "Int64"})
    if digest is not None:
        yield pd.DataFrame([(conv, digest.hexdigest())], columns=["conv_id", "repaired_sha256"]).astype(
            {"conv_id": "Int64"})


def repair(rows: DataFrame, segment: int = SEGMENT) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(placed, chosen, totals) for rows (conv_id, turn, role, text) as they are, without further damage.

    placed: the rows with their place in the conversation; a null role or text is one space. Order is by turn, nulls
    first, ties by role and text; equal rows are interchangeable. chosen: (conv_id, segment, edits) with the letters of every row. totals: counts,
    gaps and least cost per conversation.

    A conversation is cut in segments of so many rows, since one may hold a third of the table. A segment becomes
    a word of role/fault symbols, its runs are advanced through binary powers of the symbol's min-plus
    transition, and only the 4 x 4 costs of segments meet per conversation. From the costs behind it each
    segment is unrolled from every state, and the states are chained. An empty role has no initial, so it
    is never kept; all nulls of conv_id are one conversation.
    """
    rows = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                       *[F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")], F.rand(11).alias("spread"))
    placed = stored(ranked(rows, ["conv_id"], [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text"),
                                               F.col("spread")], "place").drop("spread"), "conversations")
    parts = stored(segments(faults(placed), segment).mapInPandas(_summaries, _SUMMARY), "segments")
    of_conv = F.sort_array(F.collect_list(F.struct(
        "segment", "cost", "illegal", "first", "final", "low", "high", "turns"))).alias("parts")
    chains = stored(parts.groupBy("conv_id").agg(of_conv).mapInPandas(
        _chain, "conv_id long, gaps long, illegal long, cost long, ahead array<array<long>>"), "chains")
    ahead = chains.select("conv_id", F.size("ahead").alias("n"), F.posexplode("ahead").alias("segment", "ahead"))
    ahead = _right(ahead.withColumn("segment", F.col("segment").cast("long")), "conv_id", "segment")
    ways = stored(parts.select("conv_id", "segment", "symbols").join(ahead, _same("conv_id", "segment")).select(
        "conv_id", "segment", "symbols", "ahead", (F.col("segment") == F.col("n") - 1).alias("last")).mapInPandas(
        _unroll, "conv_id long, segment long, edits array<array<string>>, behind array<int>"), "ways")
    starts = ways.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("segment", "behind"))).alias("parts"))
    starts = starts.mapInPandas(_starts, "conv_id long, starts array<int>").select(
        "conv_id", F.posexplode("starts").alias("segment", "start"))
    starts = _right(starts.withColumn("segment", F.col("segment").cast("long")), "conv_id", "segment")
    chosen = stored(ways.join(starts, _same("conv_id", "segment")).select(
        "conv_id", "segment", F.get("edits", F.col("start")).alias("edits")), "edits")
    counts = parts.groupBy("conv_id").agg(*[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")])
    totals = counts.join(_right(chains.drop("ahead"), "conv_id"), _same("conv_id")).drop("of_conv_id")
    return placed, chosen, totals


def repair_report(rows: DataFrame, originals: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """One row for every conv_id of `originals`: faults, least cost, audit and hash of the repaired rows of `rows`.

    A conversation without rows has zeros, an empty audit and the hash of the empty text. The audit and
    the hash are one value per conversation; the hash reads its rows as a sorted stream, the audit is joined from
    its segments.
    """
    placed, chosen, totals = repair(rows, segment)
    audit = chosen.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct(
        "segment", F.array_join("edits", "").alias("letters")))).alias("all")).select(
        "conv_id", F.array_join("all.letters", "").alias("audit"))
    edits = chosen.select("conv_id", "segment", F.posexplode("edits").alias("at", "edit")).select(
        F.col("conv_id").alias("of_conv_id"), (F.col("segment") * segment + F.col("at")).alias("of_place"), "edit")
    lines = placed.join(edits, _same("conv_id", "place")).select("conv_id", "place", "role", "text", "edit")
    hashes = (lines.repartition("conv_id").sortWithinPartitions("conv_id", "place")
              .mapInPandas(_digest, "conv_id long, repaired_sha256 string"))
    out = originals.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    for part in (totals, audit, hashes):
        out = out.join(_right(part, "conv_id"), _same("conv_id"), "left").drop("of_conv_id")
    zero = [F.coalesce(c, F.lit(0).cast("long")).alias(c)
            for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select("conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def op11_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    rows = documents(spark, folder, "conv_id", "turn", "role", "text", table="conversations")
    return repair_report(damaged(rows), rows)


# The cheapest way to each state of the order after each row, by (cost, audit); inserts come before a row, two at most.
OP11_SQL = r"""
WITH RECURSIVE o AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
crc AS (SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(k, ''), lambda c: ascii(c)::BIGINT)),
    lambda a, b: list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
      lambda x, y: xor(x >> 1, (x & 1) * 3988292384))), 4294967295) % 20 AS kind FROM o),
dam AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS again FROM crc WHERE kind > 0),
r AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, again) AS i,
    rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS e FROM dam),
f AS (SELECT *, CASE WHEN e = '' THEN 'blank'
    WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
    WHEN right(e, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    substr(role, 1, 1) AS c, lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS p FROM r),
ins AS (SELECT * FROM (VALUES (0, 0, 0, '', ''), (1, 1, 0, '', ''), (2, 2, 0, '', ''), (3, 3, 0, '', ''),
    (0, 2, 3, 'I', 'u'), (1, 2, 3, 'I', 'u'), (2, 3, 3, 'I', 'a'), (3, 2, 3, 'I', 'u'),
    (0, 3, 6, 'II', 'ua'), (1, 3, 6, 'II', 'ua'), (2, 2, 6, 'II', 'au'), (3, 3, 6, 'II', 'ua')) t(a, b, cost, letters, made)),
edits AS (SELECT * FROM (VALUES (0, 0, 4, 'D'), (1, 1, 4, 'D'), (2, 2, 4, 'D'), (3, 3, 4, 'D'),
    (0, 1, 0, 's'), (0, 2, 0, 'u'), (1, 2, 0, 'u'), (3, 2, 0, 'u'), (2, 3, 0, 'a'),
    (0, 2, 3, 'R'), (1, 2, 3, 'R'), (2, 3, 3, 'R'), (3, 2, 3, 'R')) t(a, b, cost, how)),
w AS (SELECT conv_id, 0::BIGINT AS i, 0 AS s, {'cost': 0::BIGINT, 'audit': '', 'lines': []::VARCHAR[]} AS best
      FROM (SELECT DISTINCT conv_id FROM r)
  UNION ALL
  SELECT f.conv_id, f.i, edits.b, min({'cost': w.best.cost + ins.cost + edits.cost
      + CASE WHEN fault = 'truncated' AND how <> 'D' THEN 3 ELSE 0 END,
    'audit': w.best.audit || ins.letters || CASE WHEN how IN ('D', 'R') THEN how ELSE 'K' END,
    'lines': list_concat(list_concat(w.best.lines, list_transform(list_filter(string_split(ins.made, ''), lambda x: x <> ''),
        lambda x: CASE x WHEN 'u' THEN 'user:' ELSE 'assistant:' END)),
      CASE how WHEN 'D' THEN [] WHEN 'R' THEN [CASE edits.b WHEN 2 THEN 'user:' ELSE 'assistant:' END || text]
        ELSE [role || ':' || text] END)}) AS best
  FROM w JOIN f ON w.conv_id IS NOT DISTINCT FROM f.conv_id AND f.i = w.i + 1 JOIN ins ON ins.a = w.s
    JOIN edits ON edits.a = ins.b AND (how = 'D' OR fault NOT IN ('blank', 'duplicate') AND (how = 'R' OR how = f.c))
  GROUP BY f.conv_id, f.i, edits.b),
n AS (SELECT conv_id, count(*) AS n, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (p || c NOT IN ('su', 'ua', 'au')) AS illegal,
    coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps FROM f GROUP BY conv_id),
z AS (SELECT w.conv_id, any_value(n) AS n, min({'cost': w.best.cost + ins.cost, 'audit': w.best.audit || ins.letters,
    'lines': list_concat(w.best.lines, list_transform(list_filter(string_split(ins.made, ''), lambda x: x <> ''),
        lambda x: CASE x WHEN 'u' THEN 'user:' ELSE 'assistant:' END))}) AS best
  FROM w JOIN n ON w.conv_id IS NOT DISTINCT FROM n.conv_id AND w.i = n.n JOIN ins ON ins.a = w.s AND ins.b IN (0, 3)
  GROUP BY w.conv_id)
SELECT d.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(z.best.cost, 0)::BIGINT AS cost,
  coalesce(z.best.audit, '') AS audit, sha256(coalesce(array_to_string(z.best.lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM o) d LEFT JOIN n ON d.conv_id IS NOT DISTINCT FROM n.conv_id
  LEFT JOIN z ON d.conv_id IS NOT DISTINCT FROM z.conv_id
"""
