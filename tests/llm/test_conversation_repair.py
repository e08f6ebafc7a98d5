"""Conversation repair: cheapest edits against an exhaustive search, whole reports against a
plain model of the rules."""

import hashlib
import itertools

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from inboxlens.llm import queries
from inboxlens.llm.conversation_repair import ASSISTANT, OTHER, SYSTEM, USER, cheapest_edits, digests, repaired, report

SCHEMA = "conv_id long, turn long, role string, text string"
WHITE = " \t\n\x0b\x0c\r"


def brute_edits(rows):
    """Least (cost, audit, repaired rows) of ``rows (role, text, must_go, truncated)``: every
    way put out is tried, dearer ones than the best are left."""
    start = 2 * len(rows) + 10 + 1  # all deleted, at least
    best = [(start, "", ())]

    def go(i, cost, audit, out):
        if cost > best[0][0]:
            return
        initials = "".join(r[0][:1] or "-" for r in out)  # no initial is none of them
        body = initials[1:] if initials[:1] == "s" else initials
        if i == len(rows) and (not initials or (body and body == "ua" * (len(body) // 2))):
            best[0] = min(best[0], (cost, audit, out))
        if body != ("ua" * len(body))[:len(body)]:
            return
        if i < len(rows):
            role, text, must_go, truncated = rows[i]
            go(i + 1, cost + 2, audit + "D", out)
            if not must_go:
                more = 5 if truncated else 0
                go(i + 1, cost + more, audit + "K", (*out, (role, text)))
                for to in ("user", "assistant"):
                    go(i + 1, cost + 1 + more, audit + "R", (*out, (to, text)))
        for to in ("user", "assistant"):
            go(i, cost + 5, audit + "I", (*out, (to, "")))

    go(0, 0, "", ())
    return best[0]


def model(conv_rows):
    """The report of one conversation's rows in order, from the rules."""
    blank = duplicate = truncated = illegal = 0
    seen, judged = set(), []
    for turn, role, text in conv_rows:
        role, text = " " if role is None else role, " " if text is None else text
        bare = text.rstrip(WHITE)
        fault = ("blank" if not bare else "duplicate" if (role, text) in seen
                 else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
        blank, duplicate, truncated = blank + (fault == "blank"), duplicate + (fault == "duplicate"), truncated + (fault == "truncated")
        if judged:
            illegal += judged[-1][0][:1] + role[:1] not in ("su", "ua", "au")
        judged.append((role, text, fault in ("blank", "duplicate"), fault == "truncated"))
    turns = [t for t, _, _ in conv_rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    cost, audit, out = brute_edits(judged)
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
    return (gaps, blank, duplicate, truncated, illegal, cost, audit, digest), out


def code(row):
    role, _, must_go, truncated = row
    who = {"u": USER, "a": ASSISTANT, "s": SYSTEM}.get(role[:1], OTHER)
    return who | (4 if must_go else 8 if truncated else 0)


@settings(max_examples=120, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "tool"]),
                          st.sampled_from(["", "must", "cut"])), max_size=6))
def test_edits_are_cheapest_and_least(rows):
    rows = [(role, "x", fault == "must", fault == "cut") for role, fault in rows]
    assert cheapest_edits(bytes(map(code, rows))) == brute_edits(rows)[:2]


def dynamic(codes):
    """Cost of the cheapest edits, forward over all states."""
    inf = 10 ** 12
    now = [0, inf, inf, inf]

    def insert(s):
        s[2] = min(s[2], 5 + min(s[0], s[1], s[3]))
        s[3] = min(s[3], 5 + s[2])
        return s

    for c in codes:
        now, new = insert(now), [x + 2 for x in now]
        if not c & 4:
            more, who = 5 if c & 8 else 0, c & 3
            to_user, to_assistant = min(now[0], now[1], now[3]) + more, now[2] + more
            new[2] = min(new[2], to_user + (who != USER))
            new[3] = min(new[3], to_assistant + (who != ASSISTANT))
            if who == SYSTEM:
                new[1] = min(new[1], now[0] + more)
        now = new
    now = insert(now)
    return min(now[0], now[3])


def test_long_conversations_over_many_blocks():
    import random
    rng = random.Random(5)
    for n in (15, 16, 17, 33, 400, 5000):
        codes = bytes(rng.choice([0, 1, 0, 1, 2, 3, 4, 9, 8]) for _ in range(n))
        cost, audit = cheapest_edits(codes)
        assert cost == dynamic(codes)
        assert sum(e != "I" for e in audit) == n
    assert cheapest_edits(bytes([USER, ASSISTANT] * 20_000)) == (0, "K" * 40_000)


def run(spark, rows, conversations=None):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    reports = report(df, conversations)
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    got = {r["conv_id"]: tuple(r[c] for c in names) for r in digests(df, reports).collect()}
    out = {}
    for r in repaired(df, reports).orderBy("conv_id", "place").collect():
        out.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    return got, out


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))


def test_reports_against_the_rules(spark):
    convs = {
        1: [(0, "system", "Be kind."), (1, "user", "Hi!"), (2, "assistant", "Hello.")],
        2: [(0, "user", "a."), (0, "user", "a."), (1, "assistant", "b.")],              # repeated row
        3: [(0, "user", "a"), (3, "assistant", "b."), (9, "user", "c.")],               # cut, gaps, no answer
        4: [(0, "assistant", "b."), (1, "assistant", "c.")],
        5: [(0, None, None), (None, "user", "q?"), (1, "assistant", " \t\n")],          # nulls, white space
        6: [(0, "user", "a."), (1, "assistant", "b."), (2, "user", ""), (3, "user", "")],  # ends in deletions
        7: [(0, "tool", "x."), (1, "system", "late."), (2, "", "no role.")],
        8: [(None, "user", "one."), (5, "assistant", "é! \x0c")],
        9: [(0, "user", " "), (1, "assistant", "word. " * 50_000)],               # no-break space is a word
        None: [(0, "user", "null id."), (1, "assistant", "kept.")],
    }
    got, out = run(spark, [(c, *r) for c, rows in convs.items() for r in rows])
    for c, rows in convs.items():
        want, text = model(ordered(rows))
        assert got[c] == want, c
        assert out.get(c, []) == list(text), c
    assert len(got) == len(convs)


def test_random_conversations(spark):
    import random
    rng = random.Random(7)
    roles, texts = ["user", "assistant", "system", "tool", None], ["a.", "b!", "c", "", " ", None, "d?"]
    convs = {c: [(rng.choice([t, t, t + 2]) * 2 + 0, rng.choice(roles[:2] * 3 + roles), rng.choice(texts))
                 for t in range(rng.randrange(1, 7))] for c in range(60)}
    for c, rows in convs.items():  # no ties: their order is the operator's own
        convs[c] = list({t: (t, r, x) for t, r, x in rows}.values())
    got, _ = run(spark, [(c, *r) for c, rows in convs.items() for r in rows])
    for c, rows in convs.items():
        assert got[c] == model(ordered(rows))[0], c


def test_conversations_without_rows_and_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    empty = hashlib.sha256(b"").hexdigest()
    ids = spark.createDataFrame([(4,), (4,), (None,)], "conv_id long")
    got, out = run(spark, [(4, 0, "user", "a."), (4, 1, "assistant", "b.")], ids)
    assert got[None] == (0, 0, 0, 0, 0, 0, "", empty) and got[4][6] == "KK" and set(out) == {4}
    assert digests(none, report(none, none)).collect() == [] and repaired(none, report(none)).collect() == []


def test_extra_columns_and_one_large_conversation(spark):
    n = 6000  # one conversation with most rows, in many tasks before the shuffle
    long = (spark.range(0, n, 1, 7).select(F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                           F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"),
                                           F.concat(F.col("id").cast("string"), F.lit(".")).alias("text")))
    clash = long.select("*", *[F.lit(9).alias(c) for c in ("kind", "key", "begin", "seen", "first", "conv", "audit", "report", "by", "again")])
    reports = report(clash)
    row = digests(clash, reports).collect()
    assert len(row) == 1 and row[0]["audit"] == "K" * n and row[0]["cost"] == 0
    text = "\n".join(f"{'user' if i % 2 == 0 else 'assistant'}:{i}." for i in range(n))
    assert row[0]["repaired_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert queries.damaged(clash).columns == ["conv_id", "turn", "role", "text"]


def test_damage(spark):
    import zlib
    rows = [(c, t, r, "Say it. Now!") for c, t, r in itertools.product([1, 2, None], [0, 1, 2, 3, 4, 5, None], ["system", None])]
    got = sorted(map(repr, map(tuple, queries.damaged(spark.createDataFrame(rows, SCHEMA)).collect())))
    want = []
    for c, t, r, x in rows:
        by = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r = "user" if by == 4 else " " if r is None else r
        x = "" if by == 1 else "Say it Now" if by == 2 else x
        want += [repr((c, t, r, x))] * (0 if by == 0 else 2 if by == 3 else 1)
    assert got == sorted(want)
