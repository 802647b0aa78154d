"""Near-duplicate documents and lines against brute force."""

import random
import re
from collections import defaultdict

import cases
import numpy as np
import xxhash
from larderline.llm.components import components
from larderline.llm.op4_line_dedup import cleaned, marked
from larderline.llm.op7_minhash import estimate, near_duplicates, registers
from tests_plan import settings


def words(text):
    return tuple((text or "").encode().lower().split())


def tokens(w):
    return {w[i : i + 5] for i in range(len(w) - 4)} if len(w) >= 5 else ({w} if w else set())


def alike(a, b):
    return bool(a and b) and 100 * len(a & b) >= 75 * len(a | b)


def copies(seed=1, families=12, members=30, n=60):
    """Families of near copies, edited more and more, with exact copies between."""
    random.seed(seed)
    rows, doc_id = [], 0
    for f in range(families):
        base = [f"f{f}w{random.randrange(400)}" for _ in range(n)]
        for m in range(members):
            text = list(base)
            for _ in range(random.choice([0, 0, 1, 1, 2, 3, 5])):
                text[random.randrange(n)] = f"e{random.randrange(10**6)}"
            rows.append((doc_id, " ".join(text).upper() if m % 7 == 0 else " ".join(text)))
            doc_id += 1
    return rows


def components_of(rows):
    sets = [tokens(words(t)) for _, t in rows]
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if alike(sets[i], sets[j]):
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    least = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(i)].append(doc_id)
    found = []
    for i, (doc_id, _) in enumerate(rows):
        component = min(least[root(i)]) if least[root(i)] else None
        found.append((doc_id, len(sets[i]), component, component is None or doc_id == component))
    return sorted(found, key=repr)


def test_near_duplicates_equal_brute_force(spark):
    rows = copies()
    random.shuffle(rows)
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    assert cases.rows_of(got) == components_of(rows)


def test_near_duplicates_of_awkward_rows(spark):
    expected = components_of([(i, t) for i, t, *_ in cases.ROWS])
    # Rows that repeat an id are one document: empty texts with a null id stay alone.
    for docs in (cases.documents(spark), cases.documents(spark, clashing=True)):
        assert cases.rows_of(near_duplicates(docs)) == expected
    assert near_duplicates(cases.empty(spark)).collect() == []


def test_estimate_is_close_at_every_size():
    random_ = np.random.default_rng(2)
    for n in (4, 40, 2000):
        values = random_.integers(0, 2**63, n, dtype=np.uint64)
        one, other = registers(values), registers(values[: n * 3 // 4])
        assert abs(estimate(np.array([(one == other).sum()]), np.array([n]), np.array([n * 3 // 4]))[0] - 0.75) < 0.19


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(1, i) for i in range(2, 40)] + [(7, 7), (500, 400), (400, 500)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 100 for i in range(100, 161)} | {i: 1 for i in range(1, 40)} | {400: 400, 500: 400}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def removed_lines(rows):
    """Places that go, by row; ids in order, null last."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0))
    seen, gone = [], defaultdict(list)
    for i in order:
        for place, line in enumerate(rows[i][1].split("\n") if rows[i][1] else []):
            w = words(line)
            if w:
                seen.append(((rows[i][0] is None, rows[i][0] or 0, place), i, w, tokens(w)))
    for at, i, w, s in seen:
        first = min(a for a, _, v, _ in seen if v == w)
        if at != first or any(a < first and alike(s, t) for a, _, v, t in seen if v != w):
            gone[i].append(at[2])
    return [(r[0], len(r[1].split("\n")) if r[1] else 0, len(gone[i]), ",".join(map(str, sorted(gone[i])))) for i, r in enumerate(rows)]


def test_lines_equal_brute_force(spark):
    # Lines of families of near copies, several to a document, and a passage inside otherwise different lines.
    random.seed(8)
    lines = [t for _, t in copies(seed=9, families=8, members=30, n=24)]
    passage = " ".join(f"p{i}" for i in range(14))
    lines += [f"{passage} only{i} here{i} and{i} x{i} y{i} z{i}" for i in range(40)] + ["two words"] * 5 + [""] * 5
    random.shuffle(lines)
    rows = [(i, "\n".join(lines[4 * i : 4 * i + 4])) for i in range(len(lines) // 4)]
    got = marked(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    assert cases.rows_of(got) == sorted(removed_lines(rows), key=repr)


def template_lines(n=120, others=120):
    """Variants of one line, one word changed in most, between lines of their own; in no order."""
    random.seed(12)
    base = [f"t{i}" for i in range(24)]
    lines = [" ".join(base[:12] + [f"v{i}"] + base[13:]) for i in range(n)]
    # Further from each other: these meet at the template's tokens and may stay.
    lines += [" ".join(base[:8] + [f"u{i}x{j}" for j in range(9)]) for i in range(n // 2)]
    lines += [" ".join(f"o{i}w{j}" for j in range(8)) for i in range(others)]
    random.shuffle(lines)
    return [(i, "\n".join(lines[3 * i : 3 * i + 3])) for i in range(len(lines) // 3)]


def test_lines_of_a_hot_token_are_dealt_to_several_groups(spark):
    from larderline.llm import op4_line_dedup as op4

    rows = template_lines()
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    order = op4.frequent(op4.line_rows(docs), 2**18)
    packed = op4.prefixes(docs, order, 16, 20).collect()
    by_token = defaultdict(lambda: defaultdict(set))
    for r in packed:
        token = np.frombuffer(r.low, np.uint32) | np.frombuffer(r.high, np.uint16).astype(np.uint64) << np.uint64(32)
        for t, name in zip(token.tolist(), np.frombuffer(r.name, np.int64).tolist()):
            by_token[t][r.bucket].add(name)
    sizes = {t: [len(x) for x in b.values()] for t, b in by_token.items()}
    assert max(sum(s) for s in sizes.values()) >= 60 and max(max(s) for s in sizes.values()) <= 40
    # A line is in one bucket of a token.
    assert all(sum(s) == len(set().union(*by_token[t].values())) for t, s in sizes.items())
    got = marked(docs, bucket_lines=20)
    assert cases.rows_of(got) == sorted(removed_lines(rows), key=repr)


def test_lines_of_awkward_rows(spark):
    # Distinct rows: repeated ones are one place and checked below.
    rows = [r for i, r in enumerate(cases.ROWS) if r not in cases.ROWS[:i]]
    expected = {e[0]: e for e in removed_lines([(i, t) for i, t, *_ in rows if i is not None])}
    for docs in (cases.documents(spark), cases.documents(spark, clashing=True)):
        got = cases.rows_of(marked(docs))
        assert len(got) == len(cases.ROWS)
        assert {g[0]: g for g in got if g[0] not in (None, 12)} == {k: v for k, v in expected.items() if k != 12}
    assert marked(cases.empty(spark)).collect() == []


def test_lines_of_null_and_repeated_ids(spark):
    # The same lines in rows that share an id or have none: one of them keeps each line, in order of the texts' hashes.
    same = " ".join(f"s{i}" for i in range(12))
    near = same.replace("s11", "other")
    rows = [(None, f"{same}\nnull {i} of its own") for i in range(3)] + [(7, f"{same}\n\nseven {i} of its own") for i in range(2)]
    rows += [(7, rows[3][1])] * 2 + [(None, rows[0][1])] * 2 + [(9, near), (9, f"{near}\nnine"), (None, f" \n{near}"), (None, " \n")] + [(None, None)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    signed = lambda t: (xxhash.xxh64_intdigest(t.encode(), 42) + 2**63) % 2**64 - 2**63 if t is not None else 42
    ranked = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, signed(r[1])))
    expected = [(r[0], *e[1:]) for r, e in zip(ranked, removed_lines([(i, t) for i, (_, t) in enumerate(ranked)]))]
    for step in (10_000, 2):
        assert cases.rows_of(marked(docs, step=step)) == sorted(expected, key=repr)
    left = [r.text for r in cleaned(docs).collect()]
    texts = "\n".join(t for t in left if t)
    assert texts.count(same) == 1 and near not in texts and texts.count("null 0") == 1 and texts.count("nine") == 1
    assert left.count(None) == 2 and " \n" in left


def test_cleaned_documents_keep_their_columns(spark):
    docs = cases.documents(spark, clashing=True)
    left = cleaned(docs)
    assert left.columns == docs.columns
    got = {r.doc_id: r.text for r in left.collect()}
    assert got[7] == "short line\n\nOne two three four five six seven"
    assert got[8] == "new words here and more of them"
    assert got[4] is None and got[5] == "" and got[6] == " \n\t " and got[9] == cases.LONG
    assert 2 not in got and 3 not in got  # copies of document 1 have no line left
    assert cleaned(cases.empty(spark)).collect() == []


def test_cleaned_documents_cross_the_network_once(spark):
    docs = cases.documents(spark, clashing=True)
    with settings(spark, {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}):
        formatted = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
        nodes = cleaned(docs)._jdf.queryExecution().explainString(formatted).split("\n\n")
    moved = [n for n in nodes if re.match(r"\(\d+\) Exchange\n", n) and re.search(r"Input.*__row#", n)]
    # Grouped as the window and the join both want them, the text in the row and not once more beside it.
    assert len(moved) == 1 and re.search(r"Input \[4\]: ", moved[0])


def test_shingles_of_the_same_words_in_another_order_differ():
    from itertools import product

    from larderline.llm.shingles import shingles

    texts = [" ".join(w) for w in product("abc", repeat=5)]
    assert len({int(shingles(t.encode())[0]) for t in texts}) == len(texts)
