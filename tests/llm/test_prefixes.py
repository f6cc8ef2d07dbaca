import hashlib
import random
import zlib
from collections import defaultdict

from depotflow.llm import prefixes
from tests.llm.helpers import words

SCHEMA = "conv_id long, turn long, role string, text string, node string, place string, depth string, n_convs string"


def conversations(spark, rows):
    return spark.createDataFrame([(*r, *["clash"] * 4) for r in rows], SCHEMA)


def brute(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(ts, key=lambda x: (x[0], x[1], x[2].encode(), x[3].encode()))] for c, ts in turns.items()}
    again = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        again[c] = tuple(own.get(c - c % 20, [])[:h] + ts[h:])
    members = defaultdict(list)
    for c, ts in again.items():
        for d in range(len(ts) + 1):
            members[ts[:d]].append(c)
    result = []
    for node, convs in members.items():
        below = [n for n in members if n[:len(node)] == node]
        ends = ",".join(str(c) for c in sorted(c for c in convs if len(again[c]) == len(node)))
        result.append((
            min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs),
            sum(len(n) == len(node) + 1 for n in below),
            sum(not any(m[:len(n)] == n and len(m) == len(n) + 1 for m in below) for n in below),
            sum((len(members[n]) - 1) * len(words(n[-1][1])) for n in below if n),
            hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(result, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.drop("node").collect()), key=repr)


def test_awkward_conversations_beside_brute_force(spark, monkeypatch):
    draw = random.Random(8)
    rows = []
    for conv in range(65):
        for turn in range(draw.choice([1, 1, 2, 3, 6])):
            rows.append((conv, turn, draw.choice(["user", "assistant", None]), draw.choice(["hi", "hi there", "", None, "a b c"])))
    rows += [(5, 1, "user", "hi")] * 3 + [(7, None, "user", "first"), (7, None, None, None), (None, 0, "user", "lost")]
    rows += [(100, n, "user", f"turn {n}") for n in range(40)] + [(119, n, "user", f"turn {n}") for n in range(40)]
    rows += [(141, 0, "user", "head is absent"), (1000, 0, "user", "ä b"), (1001, 0, "user", "ä b")]
    assert found(prefixes.trie(conversations(spark, rows))) == brute(rows)
    monkeypatch.setattr(prefixes, "CHUNK", 3)
    monkeypatch.setattr(prefixes, "IDS", 4)
    assert found(prefixes.trie(conversations(spark, rows))) == brute(rows)


def test_a_conversation_left_without_turns(spark):
    lone = next(c for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4 >= 2)
    rows = [(lone, 0, "user", "gone")]
    assert found(prefixes.trie(conversations(spark, rows))) == brute(rows)


def test_no_conversations(spark):
    result = prefixes.trie(conversations(spark, [(None, 0, "user", "lost")]))
    assert result.columns[:3] == ["conv_id", "depth", "parent_conv_id"] and not result.collect()


def totals(parents, values):
    result = dict(values)
    children = defaultdict(list)
    for node, parent in parents.items():
        children[parent].append(node)
    order = [n for n, p in parents.items() if p is None]
    for node in order:
        order.extend(children[node])
    for node in reversed(order):
        if parents[node] is not None:
            result[parents[node]] += result[node]
    return result


def test_contraction_of_trees_of_any_shape(spark):
    draw = random.Random(2)
    parents = {"r": None, "s": None}
    for n in range(150):
        parents[f"c{n}"] = f"c{n - 1}" if n else "r"  # one long chain
    for n in range(120):
        parents[f"x{n}"] = draw.choice(list(parents))
    for n in range(60):
        parents[f"h{n}"] = "x3"
    values = {node: draw.randint(-5, 50) for node in parents}
    tree = spark.createDataFrame([(n, p, values[n], 1) for n, p in parents.items()], "node string, parent string, v long, one long")
    got = {r.node: (r.total_v, r.total_one) for r in prefixes.contracted(tree, ["v", "one"]).collect()}
    one, two = totals(parents, values), totals(parents, dict.fromkeys(parents, 1))
    assert got == {n: (one[n], two[n]) for n in parents}
    assert not prefixes.contracted(tree.limit(0), ["v"]).collect()
