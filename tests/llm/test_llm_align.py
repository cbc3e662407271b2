"""Cross-tokenizer alignment against a plain loop: byte ranges, shared ends, all overlapping pairs."""

import hashlib
from collections import Counter

from shoalgrid.llm import align


def brute(rows):
    from tokenizers import Tokenizer

    _, b_tok, a_bytes, b_bytes, _, _ = align.tokenizers(align.tokenizer_path(align.A_FILE), align.tokenizer_path(align.B_FILE))
    a_tok = Tokenizer.from_file(align.tokenizer_path(align.A_FILE))
    a_tok.encode_special_tokens = True
    per, counts = [], Counter()
    for i, t in rows:
        a, b = [], []
        if t:
            a = a_tok.encode(" " + t, add_special_tokens=False).ids
            b = b_tok.encode(t)
            want = b" " + t.encode()
            if b"".join(a_bytes[x] for x in a) != want or b"".join(b_bytes[x] for x in b) != want:
                a, b = [], []

        def ranges(ids, table):
            out, at = [], 0
            for x in ids:
                out.append((at, at + len(table[x]), x))
                at += len(table[x])
            return out

        ra, rb = ranges(a, a_bytes), ranges(b, b_bytes)
        links = [(x, y) for s, e, x in ra for s2, e2, y in rb if s < e2 and s2 < e]
        counts.update(links)
        common = sorted({e for _, e, _ in ra} & {e for _, e, _ in rb})
        groups = []
        for k, cut in enumerate(common):
            lo = common[k - 1] if k else 0
            groups.append((",".join(str(x) for s, e, x in ra if lo < e <= cut), ",".join(str(y) for s, e, y in rb if lo < e <= cut)))
        digest = hashlib.sha256(";".join(f"{x}|{y}" for x, y in groups).encode()).hexdigest() if groups else ""
        per.append((i, len(a), len(b), len(groups), links, digest))
    best = {}
    for (x, y), c in counts.items():
        best[y] = max(best.get(y, 0), c)
    out = []
    for i, na, nb, ng, links, digest in per:
        out.append((i, na, nb, ng, len(links), sum(counts[p] == best[p[1]] for p in links), sum(counts[p] for p in links), digest))
    return sorted(out, key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


def run(spark, rows):
    frame = spark.createDataFrame([(i, t, 1.5) for i, t in rows], "doc_id long, text string, n_best double")
    return sorted((tuple(r) for r in align.align(frame).collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


def test_against_plain_loop(spark):
    rows = [(1, "Hello world, this is a test."), (2, "Hello  world<|endoftext|> é\nnew line <s> x"), (3, None), (4, ""),
            (5, "Ünïcödé — 漢字 and emoji 🙂 mixed."), (6, "tabs\tand\r\nreturns  "), (7, "Hello world, this is a test."),
            (7, "Hello world, this is a test."), (None, "orphan text here"), (8, "word " * 2000), (9, "   leading spaces"),
            (10, "</s><unk> plain"), (11, "\u0000 nul and ­ soft hyphen")]
    assert run(spark, rows) == brute(rows)


def test_corpus_table(spark):
    import pyarrow.parquet as pq
    table = pq.read_table("/root/testdata/sf0.001/documents.parquet", columns=["doc_id", "text"]).slice(0, 60)
    rows = list(zip(table.column("doc_id").to_pylist(), table.column("text").to_pylist()))
    found = run(spark, rows)
    assert found == brute(rows)
    assert sum(r[1] > 0 for r in found) > 30


def test_empty(spark):
    assert run(spark, []) == []
