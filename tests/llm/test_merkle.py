import hashlib
import zlib

from conftest import DOCS
from pyspark.sql import functions as F
from terrace.llm import merkle as M


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def encoded(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf_of(doc_id, text, lang, source, n_chars):
    return sha(*[encoded(v) for v in (doc_id, source, lang, n_chars, text)])


def brute_tree(nodes, arity):
    """(last node, each leaf's runs of (before, after))."""
    proofs, at, level = [[] for _ in nodes], list(range(len(nodes))), list(nodes)
    while len(level) > 1:
        runs = [level[i : i + arity] for i in range(0, len(level), arity)]
        for leaf, place in enumerate(at):
            run, slot = runs[place // arity], place % arity
            proofs[leaf].append(("".join(run[:slot]), "".join(run[slot + 1 :])))
        level, at = [sha(*run) for run in runs], [p // arity for p in at]
    return level[0], proofs


def brute(rows, arity=2):
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append((row, leaf_of(*row)))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    built = {}
    for name in names:
        groups[name].sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
        built[name] = brute_tree([leaf for _, leaf in groups[name]], arity)
    if not names:
        return []
    root, above = brute_tree([built[name][0] for name in names], arity)
    out = []
    for name, upper in zip(names, above):
        for (row, leaf), proof in zip(groups[name], built[name][1]):
            proof, node = proof + upper, leaf
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0 and row[4] is not None:
                node = leaf_of(*row[:4], row[4] + 1)
            for before, after in proof:
                node = sha(before, node, after)
            out.append((row[0], leaf, built[name][0], root, sha(*[b + a for b, a in proof]), node, node == root))
    return out


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def _rows(n, lang="en"):
    return [(i, f"text {i}", lang, None if i % 3 else f"s{i}", i if i % 5 else None) for i in range(n)]


def test_documents_equal_brute_force(docs, rows):
    got = M.documents_manifest(docs)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    # Rows of a table written once are the same whatever their order.
    assert result(got) == sorted(brute(rows), key=str)
    assert {r["verified"] for r in got.collect()} == {True, False}


def test_sizes_around_blocks(spark):
    rows = [row for n in (1, 2, 3, 63, 64, 65, 129, 4097) for row in _rows(n, f"of {n}")]
    assert result(M.documents_manifest(spark.createDataFrame(rows, DOCS))) == sorted(brute(rows), key=str)


def test_many_groups_and_ties(spark):
    rows = [(7, "same", f"l{i % 90}" if i % 90 else None, "s", 4) for i in range(400)]  # repeated rows in each group
    rows += [(7, "other", "", "s", None), (None, None, None, None, None), (2**63 - 1, "", "zz", "", 2**63 - 1)]
    assert result(M.documents_manifest(spark.createDataFrame(rows, DOCS))) == sorted(brute(rows), key=str)


def test_another_arity(spark):
    rows = _rows(200) + _rows(9, "fr") + _rows(1, None) + [(5, "x", f"g{i}", "s", 1) for i in range(12)]
    leaves = spark.createDataFrame(rows, DOCS).withColumn("leaf", M.leaf([F.col(c) for c in M.FIELDS]))
    for arity in (3,):
        got = M.manifest(leaves.select("doc_id", "lang", "leaf"), "lang", ["doc_id"], "leaf", arity)
        got = got.withColumn("folded", M.fold(F.col("leaf"), F.col("proof")))
        want = sorted(((r[0], r[1], r[2], r[3], r[4]) for r in brute(rows, arity)), key=str)
        assert result(got.select("doc_id", "leaf", "subroot", "root", M.siblings(F.col("proof")))) == want
        assert got.where("folded <> root").isEmpty()


def test_a_change_shows(spark):
    rows = _rows(100)
    before = M.documents_manifest(spark.createDataFrame(rows, DOCS)).first()["root"]
    rows[50] = (50, "text 51", *rows[50][2:])
    assert M.documents_manifest(spark.createDataFrame(rows, DOCS)).first()["root"] != before
    # Fields don't run into each other.
    assert leaf_of(1, "b", None, "a", 0) != leaf_of(1, "", None, "ab", 0)


def test_empty_and_clashing_columns(spark, docs, no_docs):
    assert M.documents_manifest(no_docs).count() == 0
    clashing = docs.withColumns({c: F.lit(1) for c in ("grp", "place", "size", "node", "leaf", "root", "proof", "part", "kept", "tie")})
    assert result(M.documents_manifest(clashing)) == result(M.documents_manifest(docs))


def test_no_hot_window(docs):
    # Windows over rows are of blocks, never of a whole group.
    plan = M.documents_manifest(docs)._jdf.queryExecution().optimizedPlan().toString()
    shifted = [line for line in plan.splitlines() if "Window [lag" in line or "Window [lead" in line]
    assert shifted and all("windowspecdefinition(grp" in line and ", block#" in line for line in shifted)
