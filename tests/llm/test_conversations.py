"""The prefix trie and the repair of conversations against brute force."""

import collections
import hashlib
import itertools
import random
import re
import zlib

import pytest

from claimweave.llm import prefix_trie, repair

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def turn_order(turn):
    return (turn is not None, turn or 0)


def rows_of(df):
    return [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, ties, repeated rows, one long conversation and ids that clash with inner names."""
    random.seed(3)
    rows = []
    roles = ["user", "assistant", "system", "tool", "", None, "user", "assistant"]
    texts = ["Hi.", "a", "", "b!", " \n", None, "x{}.", "y{}?", "z {}", "é{}. ", "end.\n"]
    for c in [None, -5, *range(40), 105, 117, 199, 2**40]:
        for t in range(70 if c == 7 else random.randint(0, 12)):
            rows.append((c, random.choice([t, t, t, t + 1, None]), random.choice(roles), (random.choice(texts) or "").format(t) or random.choice(["", None])))
    shared = [(t, "user" if t % 2 == 0 else "assistant", f"turn {t}.") for t in range(9)]
    for c in range(300, 340):
        rows += [(c, *x) for x in shared[: 3 + c % 7]]
    rows += rows[:20]
    df = spark.createDataFrame([(*r, 1, 1, "x", "y") for r in rows], SCHEMA + ", i int, segment int, name string, conv string")
    return df.repartition(3)


def trie_of(rows):
    """Nodes of the rebuilt conversations, by brute force."""
    own = collections.defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            own[c].append((*turn_order(t), r or "", x or ""))
    own = {c: [v[2:] for v in sorted(vs)] for c, vs in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        group = c - (abs(c) % 100) * (1 if c > 0 else -1)
        built[c] = own.get(group, [])[:h] + turns[h:]
    members = collections.defaultdict(list)
    for c, turns in sorted(built.items()):
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = collections.Counter(p[:-1] for p in members if p)
    out = []
    for p, convs in members.items():
        below = [q for q in members if q[: len(p)] == p]
        ends = ",".join(str(c) for c in convs if len(built[c]) == len(p))
        out.append((
            convs[0], len(p), members[p[:-1]][0] if p else None, len(convs), children[p],
            sum(not children[q] for q in below), sum((len(members[q]) - 1) * len(q[-1][1]) for q in below if q), sha(ends),
        ))
    return sorted(out, key=repr)


NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def nodes(df):
    return sorted((tuple(r) for r in prefix_trie.trie(prefix_trie.rebuilt(df)).select(NODE).collect()), key=repr)


def test_op11_equals_brute_force(spark, result):
    got = sorted((tuple(r[c] for c in NODE) for r in result("op11_prefix_trie")), key=repr)
    assert got == trie_of(rows_of(spark.read.parquet(f"{SF_DIR}/conversations.parquet"))) and len(got) > 10


def test_trie_of_odd_rows(odd):
    got = nodes(odd)
    assert got == trie_of(rows_of(odd))
    assert max(r[1] for r in got) > 60 and max(r[3] for r in got if r[1] == 3) > 20


def test_trie_of_nothing_and_of_turnless(spark, odd):
    assert nodes(odd.limit(0)) == []
    # conversation 1 takes its first turn from an absent conversation 0: it is turnless
    lone = next(c for c in range(1, 100) if zlib.crc32(str(c).encode()) % 6 > 0)
    df = spark.createDataFrame([(lone, 1, "user", "hello")], SCHEMA)
    assert nodes(df) == [(lone, 0, None, 1, 0, 1, 0, sha(str(lone)))]


def test_trie_names_link_nodes(odd):
    trie = prefix_trie.trie(prefix_trie.rebuilt(odd)).collect()
    by_name = {(r["depth"], bytes(r["name"])): r for r in trie}
    assert len(by_name) == len(trie)
    for r in trie:
        if r["depth"]:
            assert by_name[r["depth"] - 1, bytes(r["parent"])]["conv_id"] == r["parent_conv_id"]


def damaged(rows):
    out = {}
    for c, t, r, x in rows:
        kept = out.setdefault(c, [])
        r, x = " " if r is None else r, " " if x is None else x
        k = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if k:
            x = {1: "", 2: re.sub("[.!?]", "", x)}.get(k, x)
            kept += [(t, "user" if k == 4 else r, x)] * (2 if k == 3 else 1)
    return {c: sorted(v, key=lambda a: (*turn_order(a[0]), *a[1:])) for c, v in out.items()}


def faults_of(rows):
    seen, out = set(), []
    for _, r, x in rows:
        ink = re.findall(r"[^\x20\x09-\x0D]", x)
        out.append("blank" if not ink else "duplicate" if (r, x) in seen else "truncated" if ink[-1] not in ".!?" else "")
        seen.add((r, x))
    return out


MOVES = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
ROLES = {"u": "user", "a": "assistant"}


def fixed(rows):
    """Cost, audit and lines, by a table from the end that carries whole audits."""
    faults = faults_of(rows)

    def with_inserts(ways):
        ways = dict(ways)
        for _ in range(9):
            for q, c in itertools.product(range(4), "ua"):
                if (p := MOVES[q].get(c)) in ways:
                    cost, audit, lines = ways[p]
                    new = (cost + 5, "I" + audit, [ROLES[c] + ":", *lines])
                    ways[q] = min(ways.get(q, new), new, key=lambda v: v[:2])
        return ways

    ways = with_inserts({0: (0, "", []), 3: (0, "", [])})
    for (_, role, text), fault in zip(reversed(rows), reversed(faults), strict=True):
        new = {}
        for q in range(4):
            found = [(c + 2, "D" + a, lines) for c, a, lines in [ways[q]] if q in ways] if q in ways else []
            if fault in ("", "truncated"):
                more = 5 * (fault == "truncated")
                for ch, p in MOVES[q].items():
                    if p in ways:
                        c, a, lines = ways[p]
                        if role[:1] == ch:
                            found.append((c + more, "K" + a, [f"{role}:{text}", *lines]))
                        if ch != "s":
                            found.append((c + more + 1, "R" + a, [f"{ROLES[ch]}:{text}", *lines]))
            if found:
                new[q] = min(found, key=lambda v: v[:2])
        ways = with_inserts(new)
    return ways[0]


def repaired(rows):
    out = {}
    for c, kept in damaged(rows).items():
        turns = [t for t, _, _ in kept if t is not None]
        initials = [r[:1] for _, r, _ in kept]
        faults = faults_of(kept)
        cost, audit, lines = fixed(kept)
        out[c] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False)),
            cost, audit, sha("\n".join(lines)),
        )
    return out


FIXED = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def test_op12_equals_brute_force(spark, result):
    got = {r["conv_id"]: tuple(r[c] for c in FIXED) for r in result("op12_repair")}
    assert got == repaired(rows_of(spark.read.parquet(f"{SF_DIR}/conversations.parquet")))


@pytest.mark.parametrize("segment", [repair.SEGMENT, 1, 3, 32])
def test_repair_of_odd_rows_in_segments(odd, segment):
    got = {r["conv_id"]: tuple(r[c] for c in FIXED) for r in repair.damaged_and_repaired(odd, segment).collect()}
    assert got == repaired(rows_of(odd))
    assert {x for r in got.values() for x in r[6]} >= set("DKR")


def test_repair_of_nothing_and_of_all_dropped(spark, odd):
    assert repair.damaged_and_repaired(odd.limit(0)).count() == 0
    lost = next(t for t in range(1000) if zlib.crc32(f"3:{t}".encode()) % 20 == 0)
    df = spark.createDataFrame([(3, lost, "user", "gone")], SCHEMA)
    assert [tuple(r) for r in repair.damaged_and_repaired(df).collect()] == [(3, 0, 0, 0, 0, 0, 0, "", sha(""))]


def test_the_agenda_finds_the_lightest_of_all_edits():
    """Every way to edit a few rows, one by one."""
    random.seed(5)
    for _ in range(40):
        n = random.randint(0, 4)
        initials, faults = "".join(random.choice("suax") for _ in range(n)), [random.choice([0, 0, 3, 1]) for _ in range(n)]
        best = None
        for plan in itertools.product("DKRI", repeat=n + 2):
            for length in range(n, n + 3):
                edits = "".join(plan[:length])
                if sum(e != "I" for e in edits) != n:
                    continue
                state, cost, i = 0, 0, 0
                for e in edits:
                    if e == "I":
                        c = "a" if state == 2 else "u"
                        cost, state = cost + 5, MOVES[state][c]
                        continue
                    c = initials[i] if e == "K" else "a" if state == 2 else "u"
                    if e != "D":
                        if faults[i] == 1 or c not in MOVES[state]:
                            break
                        state = MOVES[state][c]
                    cost += {"D": 2, "R": 1, "K": 0}[e] + 5 * (faults[i] == 3 and e != "D")
                    i += 1
                else:
                    if state in (0, 3) and (best is None or (cost, edits) < best):
                        best = (cost, edits)
        final = repair.derive(list(initials), faults, repair.ACCEPTING, True, (0,))
        assert (final[0, 0][0], repair.audit_of(final, 0)) == best
