"""Conversation repair, decontamination and filter audit against plain computations."""

import hashlib
import random
import re
import zlib
from collections import defaultdict
from itertools import permutations, product

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemart.llm import conversation_repair as repair
from tidemart.llm.conversation_repair import damaged, op11_conversation_repair, repair_report
from tidemart.llm.decontamination import contamination
from tidemart.llm.filter_audit import filter_audit, positional_popcount

CONV = "conv_id long, turn long, role string, text string"
DOCS = "doc_id long, text string, lang string"
EMPTY_HASH = hashlib.sha256(b"").hexdigest()


# ---- conversation repair ----

def blank(text):
    return not text.strip(" \t\n\x0b\f\r")


def row_faults(rows):
    seen, out = set(), []
    for role, text in rows:
        end = text.rstrip(" \t\n\x0b\f\r")
        out.append("blank" if not end else "duplicate" if (role, text) in seen
                   else "" if end[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def every_repair(rows):
    """The least (cost, audit, lines) of all edits with at most two inserts between rows."""
    faults = row_faults(rows)
    added = [c for n in range(3) for c in product(("user", "assistant"), repeat=n)]
    options = []
    for (role, text), fault in zip(rows, faults, strict=True):
        own = [("D", 4, [])]
        if fault not in ("blank", "duplicate"):
            more = 3 if fault == "truncated" else 0
            own += [("K", more, [(role, text)]), *[("R", 3 + more, [(r, text)]) for r in ("user", "assistant")]]
        options.append(own)
    best = None
    for before in product(added, repeat=len(rows) + 1):
        for chosen in product(*options):
            cost = sum(c for _, c, _ in chosen) + 3 * sum(map(len, before))
            if best and cost > best[0]:
                continue
            lines, audit = [], ""
            for ins, (letter, _, own) in zip(before, [*chosen, ("", 0, [])], strict=True):
                audit += "I" * len(ins) + letter
                lines += [(r, "") for r in ins] + own
            if re.fullmatch("(s?(ua)+)?", "".join(r[:1] or "?" for r, _ in lines)):
                best = min(best or (cost, audit, lines), (cost, audit, lines))
    return best


def by_states(rows):
    """The same by the cheapest way to each end of the output, for longer conversations."""
    def legal(out):  # a beginning of a legal order
        return re.fullmatch("s?(ua)*u?", "".join(r[:1] or "?" for r, _ in out))

    def end(out):
        return out[-1][0][:1] if out else ""

    ways = {"": (0, "", [])}
    for (role, text), fault in [*zip(rows, row_faults(rows), strict=True), ((None, None), None)]:
        opened = [(c + 3 * len(add), a + "I" * len(add), o + [(r, "") for r in add]) for c, a, o in ways.values()
                  for n in range(3) for add in product(("user", "assistant"), repeat=n)]
        opened = [w for w in opened if legal(w[2])]
        if fault is None:
            done = [w for w in opened if re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r, _ in w[2]))]
            return min(done)
        following = defaultdict(list)
        for c, a, o in opened:
            following[end(o)].append((c + 4, a + "D", o))
            if fault in ("blank", "duplicate"):
                continue
            more = 3 if fault == "truncated" else 0
            for letter, cost, r in (("K", 0, role), ("R", 3, "user"), ("R", 3, "assistant")):
                if legal([*o, (r, text)]):
                    following[end([*o, (r, text)])].append((c + cost + more, a + letter, [*o, (r, text)]))
        ways = {k: min(v) for k, v in following.items()}


def expected_row(rows, solve):
    """rows: (turn, role, text) after damage, in order."""
    plain = [(r, t) for _, r, t in rows]
    faults = row_faults(plain)
    turns = [t for t, _, _ in rows if t is not None]
    initials = [r[:1] for r, _ in plain]
    cost, audit, lines = solve(plain)
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False)), cost, audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest())


COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))


def check_report(spark, conversations, solve, segment):
    rows = [(c, t, r, x) for c, part in conversations.items() for t, r, x in part]
    df = spark.createDataFrame(rows, CONV)
    got = {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in repair_report(df, df, segment).collect()}
    assert got == {c: expected_row(ordered(part), solve) for c, part in conversations.items()}


def random_rows(rng, n, turns=True):
    return [(rng.choice([None, *range(6)]) if turns else i, rng.choice(["user", "user", "assistant", "assistant", "system",
             "tool", "ukulele", ""]), rng.choice(["a.", "b.", "c", "Ü?\n", " ", "", "d! "])) for i in range(n)]


def test_repairs_of_short_conversations_against_all_edits(spark):
    rng = random.Random(5)
    check_report(spark, {i: random_rows(rng, rng.randint(1, 2)) for i in range(120)}, every_repair, 1)
    check_report(spark, {None: random_rows(rng, 3), 7: random_rows(rng, 3)}, every_repair, 2)


@pytest.mark.parametrize("segment", [3, 4096])
def test_repairs_across_segments(spark, segment):
    rng = random.Random(segment)
    conversations = {i: random_rows(rng, rng.randint(1, 40), turns=i % 2 == 0) for i in range(30)}
    conversations[100] = [(i, "user", f"q{i}.") for i in range(60)]  # one run
    conversations[101] = [(i, ("user", "assistant")[i % 2], "same.") for i in range(50)]
    conversations[102] = [(None, "user", "x.")] * 40
    check_report(spark, conversations, by_states, segment)


def test_one_conversation_holds_most_rows(spark):
    rng = random.Random(3)
    hot = [(i, rng.choice(["user", "assistant"]), f"{rng.randint(0, 900)}{rng.choice(['.', ''])}") for i in range(1500)]
    check_report(spark, {1: hot, 2: hot[:3]}, by_states, 64)


def test_run_powers_equal_steps():
    for symbol in "suaoSUAOx":
        step, many = repair.power(symbol, 0), np.where(np.eye(4, dtype=bool), 0, repair.FAR)
        for n in range(1, 12):
            many = repair._plus(many, step)
            assert (repair.transition(symbol * n) == many).all()


def test_damage_and_report_of_nulls_and_repeats(spark):
    rows = [(c, t, r, x) for c in (None, 1, 2, 3) for t in (None, *range(30))
            for r, x in (("user", "a. b"), (None, "c!"), ("assistant", None))]
    df = spark.createDataFrame(rows + rows[:9], CONV).withColumn("again", F.lit(1)).withColumn("kind", F.lit("k"))
    left = defaultdict(list)
    for c, t, r, x in rows + rows[:9]:
        r, x = r or " ", " " if x is None else x
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if kind == 0:
            continue
        x = "" if kind == 1 else re.sub("[.!?]", "", x) if kind == 2 else x
        left[c] += [(t, "user" if kind == 4 else r, x)] * (2 if kind == 3 else 1)
    got = {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in repair_report(damaged(df), df, 16).collect()}
    assert got == {c: expected_row(ordered(left[c]), by_states) for c in (None, 1, 2, 3)}


def test_conversation_without_rows_after_damage(spark, tmp_path):
    turn = next(t for t in range(100) if zlib.crc32(f"5:{t}".encode()) % 20 == 0)
    for rows in ([(5, turn, "user", "x")], []):
        folder = str(tmp_path / f"conv{len(rows)}")
        spark.createDataFrame(rows, CONV).write.parquet(f"{folder}/conversations.parquet")
        got = [tuple(r) for r in op11_conversation_repair(spark, folder).collect()]
        assert got == [(5, 0, 0, 0, 0, 0, 0, "", EMPTY_HASH)] * len(rows)


# ---- decontamination ----

def item_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_contamination(docs, items):
    windows = defaultdict(set)
    for item, text in items:
        words = item_words(text)
        for i in range(max(1, len(words) - 9)) if words else ():
            windows[tuple(words[i:i + 10])].add("" if item is None else str(item))
    out = []
    for doc_id, text in docs:
        words, hit, found = item_words(text), set(), set()
        for window, names in windows.items():
            for i in range(len(words) - len(window) + 1):
                if tuple(words[i:i + len(window)]) == window:
                    hit.update(range(i, i + len(window)))
                    found |= names
        out.append((doc_id, len(words), len(hit), len(found),
                    hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return out


def contaminated(spark, docs, items):
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumns(
        {c: F.lit("x") for c in ("key", "words", "window")})
    b = spark.createDataFrame(items, "item_id long, text string").withColumn("size", F.lit(0))
    return [tuple(r) for r in contamination(d, b).collect()]


def key(rows):
    return sorted(rows, key=repr)


def test_contamination_against_brute_force(spark):
    rng = random.Random(8)
    vocabulary = ["aa", "Bb", "ß", "c1", "ÉÉ", "x"]

    def text(n):
        return "".join(rng.choice(vocabulary) + rng.choice([" ", ", ", "\x00", "-"]) for _ in range(n))

    items = [(i, text(rng.choice([1, 2, 3, 4, 9, 10, 11, 25]))) for i in range(25)]
    items = [i for i in items if len(item_words(i[1])) > 1] + [(99, "x x x x x x x x x x x"), (None, "ß c1 ß")]
    items += [items[0], (100, items[1][1]), (101, None), (102, " .,")]
    docs = [(i, text(rng.randint(0, 60))) for i in range(60)]
    docs += [(i, text(5) + (rng.choice(items)[1] or "") + "; " + text(5)) for i in range(60, 90)]
    docs += [(200 + i, docs[70][1]) for i in range(40)] + [docs[71], docs[71], (None, docs[72][1]), (300, None), (301, "")]
    docs += [(302, "x " * 3000)]
    assert key(contaminated(spark, docs, items)) == key(brute_contamination(docs, items))


def test_contamination_of_empty_tables(spark):
    doc = (1, 2, 0, 0, EMPTY_HASH, False)
    assert contaminated(spark, [(1, "a b")], []) == [doc]
    assert contaminated(spark, [(1, "a b")], [(1, None), (2, "..")]) == [doc]
    assert contaminated(spark, [], [(1, "a b")]) == []


# ---- filter audit ----

def brute_audit(docs, labels):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t, _ in docs]
    least = {}
    for d, t, _ in docs:
        if d is not None:
            least[t or ""] = min(d, least.get(t or "", d))
    fails = []
    for (d, t, _), w in zip(docs, words, strict=True):
        t = t or ""
        fails.append({c for c, bad in zip("ABCDE", (
            len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
            bool(re.search("[#$%&*|]", t)), d is not None and d > least[t]), strict=True) if bad})
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, x in labels if x == 1 and d is not None}
    out = []
    for part in {lang or "" for _, _, lang in docs}:
        mine = [(d, f) for (d, _, lang), f in zip(docs, fails, strict=True) if (lang or "") == part]
        rows = []
        for order in permutations("ABCDE"):
            left = mine
            for step, name in enumerate(order, 1):
                removed = [m for m in left if name in m[1]]
                left = [m for m in left if name not in m[1]]
                rows.append((part, "".join(order), step, len(left), len(removed),
                             sum(name in f for _, f in mine) - len(removed), sum(f == {name} for _, f in mine),
                             sum(d in good for d, _ in removed), sum(d in toxic for d, _ in removed)))
        share = defaultdict(int)
        for r in rows:
            share[r[1][r[2] - 1]] += r[4]
        out += [(*r, share[r[1][r[2] - 1]]) for r in rows]
    return out


def test_filter_audit_against_brute_force(spark):
    rng = random.Random(2)

    def text():
        n = rng.choice([0, 5, 199, 200, 260])
        words = [rng.choice(["ab", "Cd", "é", "x#", "Y"]) if rng.random() < 0.5 else f"w{rng.randint(0, 400)}"
                 for _ in range(n)]
        return rng.choice([" ", "\n", "  "]).join(words)

    docs = [(i, text(), rng.choice(["en", "de", None, ""])) for i in range(300)]
    docs += [(1000 + i, docs[3][1], "en") for i in range(300)]  # a third are copies
    docs += [(5, docs[5][1], "en"), (5, docs[5][1], "en"), (None, docs[3][1], "fr"), (None, None, "fr"), (7000, None, "fr")]
    labels = [(rng.randint(0, 320), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(400)]
    labels += [(None, 1, 1), (9999, 1, 1)]
    d = spark.createDataFrame(docs, DOCS).withColumns({c: F.lit(1) for c in ("good", "part", "bits", "key")})
    got = filter_audit(d, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert key(tuple(r) for r in got.collect()) == key(brute_audit(docs, labels))


def test_filter_audit_of_nothing(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit(spark.createDataFrame([], DOCS), labels).count() == 0
    assert filter_audit(spark.createDataFrame([(1, None, None)], DOCS), labels).count() == 600


def test_carry_save_counts():
    rng = np.random.default_rng(4)
    for n in (0, 1, 2, 3, 10, 1000, 4097):
        words = rng.integers(0, 1 << 32, n, dtype=np.uint64).astype(np.uint32)
        expected = [int(((words >> np.uint32(b)) & np.uint32(1)).sum()) for b in range(32)]
        assert positional_popcount(words).tolist() == expected
