"""Alignment of two tokenizations of the same texts, with corpus-wide counts of linked token pairs.

Tokenizer A (byte-level BPE) encodes ``" " + text``; tokenizer B (sentencepiece BPE, which adds the space
itself) encodes ``text``; special-token strings inside texts are plain text. A token's bytes: A's vocabulary
entry decoded from the byte-level alphabet, B's piece in UTF-8 with U+2581 as a space and ``<0xHH>`` as
the byte HH. A text whose joined A or B bytes are not ``" " + text`` (or a null or empty text) has no
tokens: all counts zero and ``groups_sha256`` empty.

Each Arrow batch is worked as columns: token lists are flattened with their parent indices, byte
lengths looked up by id and summed with one running sum over the batch (texts are laid end to end,
so a global offset is a document's offset plus the offset within it). Ends shared by both
tokenizations are found by a hash join on (document, end); they cut the tokens into groups. Links,
all A-B pairs of occurrences whose byte ranges overlap, come from two binary searches per A token.
Each document's links are counted per (A id, B id) by ``Table.group_by``; Spark sums these partial
counts over the corpus, takes the highest count of every B id, and joins both back per document.

Per document: ``n_links``; ``n_best``, links whose pair count is the highest of their B id (ties count);
``count_sum``, the pair counts summed over its links; ``groups_sha256``, the SHA-256 of
``a1,a2|b1;a3|b2,b3`` (ids of each group in order). Repeated rows are documents of their own and count
twice; a null doc_id keeps its row and its links count. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoalgrid.llm.common import chunks, map_arrow, stage
from shoalgrid.operators.skew import lookup

A_FILE = "byte_bpe_50k.json"
#: The same vocabulary as ranks: A is encoded by tiktoken, which returns bare id lists (the ``tokenizers``
#: encodings also hold strings, offsets and masks of every token, several hundred MB a few MB of text);
#: the tests encode with ``tokenizers`` from ``A_FILE`` and compare.
A_RANKS = "byte_bpe_50k.tiktoken"
B_FILE = "piece_bpe_32k.model"

_ROWS = ("row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
         "pairs array<struct<a:int,b:int,k:long>>")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_alphabet() -> dict[str, int]:
    """The byte-level alphabet: printable bytes stand for themselves, the rest take 256, 257, ... in order."""
    kept = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAC + 1), *range(0xAE, 0xFF + 1)]
    extra = [b for b in range(256) if b not in kept]
    return {**{chr(b): b for b in kept}, **{chr(256 + n): b for n, b in enumerate(extra)}}


@lru_cache(maxsize=4)
def tokenizers(a_path: str, b_path: str):
    """Both tokenizers and the bytes of every id, once per Python worker."""
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(a_path)
    alphabet = _byte_alphabet()
    a_bytes = [b""] * a.get_vocab_size()
    for token, i in a.get_vocab().items():
        a_bytes[i] = bytes(alphabet[c] for c in token) if all(c in alphabet for c in token) else token.encode()
    b = sentencepiece.SentencePieceProcessor(model_file=b_path)
    b_bytes = []
    for i in range(b.get_piece_size()):
        piece = b.id_to_piece(i)
        if b.is_byte(i):
            b_bytes.append(bytes([int(piece[3:5], 16)]))
        elif b.is_control(i) or b.is_unknown(i):
            b_bytes.append(b"")
        else:
            b_bytes.append(piece.replace("▁", " ").encode())
    lengths = lambda table: np.array([len(x) for x in table], dtype=np.int64)
    return _ranked(a_path), b, a_bytes, b_bytes, lengths(a_bytes), lengths(b_bytes)


def _ranked(a_path: str):
    """tiktoken encoder of the rank file beside ``a_path``, without special tokens."""
    import base64
    import os

    import public_tokenizers
    import tiktoken

    ranks_path = os.path.join(os.path.dirname(a_path), A_RANKS)
    with open(ranks_path, "rb") as handle:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, handle) if token}
    return tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


_SEPARATORS = np.array(["", ";", "|", ","], dtype=object)


@lru_cache(maxsize=2)
def _names(size: int) -> np.ndarray:
    """Decimal text of every id below ``size``."""
    return np.array([str(i) for i in range(size)], dtype=object)


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Flat ids and parent (document) index of each, by Arrow's list flattening."""
    array = pa.array(lists, type=pa.list_(pa.int32()))
    return np.asarray(pc.list_flatten(array), dtype=np.int64), np.asarray(pc.list_parent_indices(array), dtype=np.int64)


def align_batch(texts: list[str | None], a_path: str, b_path: str) -> dict[str, list]:
    """Counts, group digests and per-document pair counts of one batch of texts."""
    a_tok, b_tok, a_bytes, b_bytes, a_len, b_len = tokenizers(a_path, b_path)
    n = len(texts)
    valid = [bool(t) for t in texts]
    plain = [t if v else "" for t, v in zip(texts, valid)]
    a_ids = a_tok.encode_ordinary_batch([" " + t for t in plain], num_threads=1)
    b_ids = b_tok.encode(plain, num_threads=1)
    for d, t in enumerate(plain):
        if valid[d]:
            want = b" " + t.encode()
            if a_tok.decode_bytes(a_ids[d]) != want or b"".join(map(b_bytes.__getitem__, b_ids[d])) != want:
                valid[d] = False
    a_ids = [ids if v else [] for ids, v in zip(a_ids, valid)]
    b_ids = [ids if v else [] for ids, v in zip(b_ids, valid)]
    a_flat, a_doc = _flat(a_ids)
    b_flat, b_doc = _flat(b_ids)
    # Texts laid end to end: one running sum gives global ends; both tokenizations cover the same bytes.
    a_end = np.cumsum(a_len[a_flat])
    b_end = np.cumsum(b_len[b_flat])
    a_start, b_start = a_end - a_len[a_flat], b_end - b_len[b_flat]
    # Ends of both, by a hash join on (document, end) that carries each side's token number; a token's
    # group is the number of shared ends before its own.
    common = pa.table({"doc": a_doc, "end": a_end, "ia": np.arange(len(a_end))}).join(
        pa.table({"doc": b_doc, "end": b_end, "ib": np.arange(len(b_end))}), ["doc", "end"], join_type="inner")
    a_cut_at, b_cut_at = np.zeros(len(a_end), np.int64), np.zeros(len(b_end), np.int64)
    a_cut_at[np.asarray(common.column("ia"), dtype=np.int64)] = 1
    b_cut_at[np.asarray(common.column("ib"), dtype=np.int64)] = 1
    a_group, b_group = np.cumsum(a_cut_at) - a_cut_at, np.cumsum(b_cut_at) - b_cut_at
    # Links: for A token i, the B tokens from the first ending after its start to the last starting before its end.
    first = np.searchsorted(b_end, a_start, side="right")
    last = np.searchsorted(b_start, a_end, side="left") - 1
    reach = np.maximum(last - first + 1, 0)
    link_a = np.repeat(np.arange(len(a_flat)), reach)
    offsets = np.cumsum(reach) - reach
    link_b = np.repeat(first - offsets, reach) + np.arange(int(reach.sum()))
    links = pa.table({"doc": a_doc[link_a], "a": a_flat[link_a].astype(np.int32), "b": b_flat[link_b].astype(np.int32)})
    counted = links.group_by(["doc", "a", "b"]).aggregate([([], "count_all")])
    pair_doc = np.asarray(counted.column("doc"), dtype=np.int64)
    order = np.argsort(pair_doc, kind="stable")
    pa_, pb_, pk_ = (np.asarray(counted.column(c))[order] for c in ("a", "b", "count_all"))
    pair_cut = np.searchsorted(pair_doc[order], np.arange(n + 1))
    a_cut = np.searchsorted(a_doc, np.arange(n + 1))
    b_cut = np.searchsorted(b_doc, np.arange(n + 1))
    link_counts = np.bincount(a_doc[link_a], minlength=n) if len(link_a) else np.zeros(n, np.int64)
    # Group texts: all tokens ordered by (group, A before B, place); a separator code before each one:
    # none at a document's start, ';' at a group's, '|' where B starts within a group, ',' otherwise.
    group = np.concatenate([a_group, b_group])
    side = np.concatenate([np.zeros(len(a_flat), np.int8), np.ones(len(b_flat), np.int8)])
    order = np.lexsort((np.concatenate([np.arange(len(a_flat)), np.arange(len(b_flat))]), side, group))
    ids, group, side = np.concatenate([a_flat, b_flat])[order], group[order], side[order]
    owner = np.concatenate([a_doc, b_doc])[order]
    same_doc = np.r_[False, owner[1:] == owner[:-1]]
    same_group = np.r_[False, group[1:] == group[:-1]]
    same_side = np.r_[False, side[1:] == side[:-1]]
    code = np.where(~same_doc, 0, np.where(~same_group, 1, np.where(~same_side, 2, 3)))
    pieces = _SEPARATORS[code] + _names(max(len(a_bytes), len(b_bytes)))[ids] if len(ids) else np.zeros(0, object)
    piece_cut = np.searchsorted(owner, np.arange(n + 1))
    group_counts = np.bincount(a_doc[np.r_[True, np.diff(a_group) != 0]] if len(a_group) else np.zeros(0, np.int64), minlength=n)
    out = {"n_a": (a_cut[1:] - a_cut[:-1]).tolist(), "n_b": (b_cut[1:] - b_cut[:-1]).tolist(), "n_links": link_counts.tolist(),
           "n_groups": group_counts.tolist(), "groups_sha256": []}
    for d in range(n):
        p0, p1 = piece_cut[d], piece_cut[d + 1]
        out["groups_sha256"].append(hashlib.sha256("".join(pieces[p0:p1].tolist()).encode()).hexdigest() if p1 > p0 else "")
    found = pa.StructArray.from_arrays([pa.array(pa_, pa.int32()), pa.array(pb_, pa.int32()), pa.array(pk_, pa.int64())], names=["a", "b", "k"])
    out["pairs"] = pa.ListArray.from_arrays(pa.array(pair_cut, pa.int32()), found)
    return out


def _tokens(a_path: str, b_path: str):
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text", 1 << 20):
            found = align_batch(batch.column("text").to_pylist(), a_path, b_path)
            yield pa.RecordBatch.from_pydict({"row": batch.column("row"), "doc_id": batch.column("doc_id"), **found},
                                             schema=pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()),
                                                               ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string()),
                                                               ("pairs", pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("k", pa.int64())])))]))
    return step


def align(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 (see the module)."""
    a_path, b_path = a_path or tokenizer_path(A_FILE), b_path or tokenizer_path(B_FILE)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_column).cast("long").alias("doc_id"),
                       F.col(text_column).cast("string").alias("text"))
    tokens = stage(map_arrow(rows, _tokens(a_path, b_path), _ROWS), "aligned")
    pairs = tokens.select("row", F.explode("pairs").alias("p")).select("row", "p.a", "p.b", "p.k")
    counts = pairs.groupBy("a", "b").agg(F.sum("k").alias("count"))
    best = counts.groupBy("b").agg(F.max("count").alias("best"))
    scored = stage(counts.join(best, "b"), "pair-counts")
    per_row = (lookup(pairs, scored, ["a", "b"], "inner")
               .groupBy("row").agg(F.sum(F.when(F.col("count") == F.col("best"), F.col("k")).otherwise(0)).alias("n_best"),
                                   F.sum(F.col("k") * F.col("count")).alias("count_sum")))
    return (tokens.drop("pairs").join(per_row, "row", "left")
            .select("doc_id", "n_a", "n_b", "n_groups", "n_links",
                    F.coalesce("n_best", F.lit(0)).cast("long").alias("n_best"),
                    F.coalesce("count_sum", F.lit(0)).cast("long").alias("count_sum"), "groups_sha256"))
