"""Best-fit packing of token sequences, in bulk-synchronous rounds over sorted runs.

Method: documents are tokenized, closed by id 0 and cut where longer than LIMIT. Pieces are sorted by
length and open sequences by the gap they have left. A round takes the longest unplaced length, sweeps the
gaps from the smallest that is large enough upwards (the successor first), gives the pieces of that length
out by rank, puts what finds no gap into new sequences, updates the gaps and goes on with the next length.

Pieces of one length are interchangeable, and so are sequences with one gap. So the sort keeps runs: at most
LIMIT lengths with a count each (a distributed sum), and gaps as intervals of sequence numbers. A sweep
works on those runs, whose number LIMIT bounds whatever the corpus, and its matches are intervals of ranks;
every piece then looks its own rank up in them (a distributed numbering and one join on the length). Ranks
resolve conflicts exactly, so one pass over a run equals as many rounds of single matches as it has pieces.

Defined cases: null text is empty, and an empty text is the one id 0; repeated rows are packed each; a null
doc_id is kept; an empty table gives an empty table; columns other than doc_id and text are not read.
"""

from __future__ import annotations

import json
import re
import sys
import types
import zlib
from bisect import bisect_left, insort

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from marquee.llm.common import numbered
from marquee.sources.scratch import keep

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LIMIT = 2048
END = 0
LONGEST_RUN = 100_000  # characters of white space the faster encoder is given in one run
ROWS_OUT = 20_000      # pieces handed to the JVM at a time
# Fixed value: the pre-tokenizer's public pattern.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_names() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(hidden)}


def encoder(vocabulary: str):
    """text -> ids for the content of a byte-level BPE file whose ids follow its merges.

    The same ids as the tokenizers library gives for the file (a test compares them), four times as fast.
    Its pattern backtracks in white space, so a text with a run above LONGEST_RUN goes to the library itself.
    """
    import tiktoken

    file = json.loads(vocabulary)
    names = byte_names()
    special = {t["content"]: t["id"] for t in file["added_tokens"]}
    ranks = {bytes(names[c] for c in word): n for word, n in file["model"]["vocab"].items() if word not in special}
    bpe = tiktoken.Encoding("packing", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)

    def encode(text: str) -> np.ndarray:
        if len(text) > LONGEST_RUN and any(len(run.group()) > LONGEST_RUN for run in re.finditer(r"\s+", text)):
            import tokenizers

            slow = tokenizers.Tokenizer.from_str(vocabulary)
            return np.asarray(slow.encode(text, add_special_tokens=False).ids, dtype=np.uint32)
        return np.asarray(bpe.encode_to_numpy(text, allowed_special="all"), dtype=np.uint32)

    return encode


def worker_encoder(vocabulary, digest: int):
    """The encoder of a broadcast vocabulary, built once in each Python worker and not once a task."""
    kept = sys.modules.setdefault("marquee_packing_encoders", types.ModuleType("marquee_packing_encoders")).__dict__
    if kept.get("digest") != digest:
        kept.update(digest=digest, encode=encoder(vocabulary.value))
    return kept["encode"]


def token_pieces(docs: DataFrame, tokenizer: str | None = None, limit: int = LIMIT, ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length and ids_crc32 (little-endian unsigned 32-bit ids) of every piece; with `ids`, the ids too.

    Only texts longer than `limit` ids are cut; the first piece takes the odd rest, the others are full.
    The driver reads the tokenizer file and sends its content (a megabyte or so) along.
    """
    spark = docs.sparkSession
    with open(tokenizer or default_tokenizer(), encoding="utf-8") as f:
        content = f.read()
    vocabulary, digest = spark.sparkContext.broadcast(content), zlib.crc32(content.encode())
    id_type = dict(docs.dtypes)["doc_id"]

    def run(batches):
        encode = worker_encoder(vocabulary, digest)
        for batch in batches:
            out: list[tuple] = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                found = np.append(encode(text or ""), np.uint32(END)).astype("<u4")
                first = (len(found) - 1) % limit + 1
                cuts = [0, *range(first, len(found) + 1, limit)]
                for n, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    some = found[a:b].tobytes()
                    out.append((doc_id, n, a, b - a, zlib.crc32(some), *([some] if ids else [])))
                if len(out) >= (ROWS_OUT // 10 if ids else ROWS_OUT):
                    yield table(out)
                    out = []
            yield table(out)

    def table(out: list[tuple]) -> pd.DataFrame:
        frame = pd.DataFrame(out, columns=["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if ids else [])])
        if id_type in ("bigint", "int"):
            frame["doc_id"] = frame["doc_id"].astype("Int64")
        return frame

    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    schema = f"doc_id {id_type}, piece int, start bigint, length bigint, ids_crc32 bigint" + (", ids binary" if ids else "")
    return texts.mapInPandas(run, schema)


def sweep(counts: dict[int, int], limit: int = LIMIT) -> list[tuple[int, int, int, int, int, int]]:
    """Matches (length, first rank, pieces, first sequence, pieces a sequence, offset) of best fit.

    `counts` has at most `limit` entries. Gaps are intervals [first, last) of sequence numbers.
    """
    gaps: dict[int, list[tuple[int, int]]] = {}
    sizes: list[int] = []  # gaps there are, ascending
    opened = 0
    found: list[tuple[int, int, int, int, int, int]] = []

    def leave(gap: int, first: int, last: int) -> None:
        if gap and last > first:
            if gap not in gaps:
                gaps[gap] = []
                insort(sizes, gap)
            gaps[gap].append((first, last))

    def fill(length: int, rank: int, rest: int, gap: int, first: int, last: int) -> int:
        """Put up to `rest` pieces into sequences [first, last) that have `gap` left; how many went in."""
        each = gap // length
        put = min(rest, each * (last - first))
        whole, odd = divmod(put, each)
        if whole:
            found.append((length, rank, whole * each, first, each, limit - gap))
            leave(gap - each * length, first, first + whole)
        if odd:
            found.append((length, rank + whole * each, odd, first + whole, odd, limit - gap))
            leave(gap - odd * length, first + whole, first + whole + 1)
        leave(gap, first + whole + (odd > 0), last)
        return put

    for length in sorted(counts, reverse=True):
        rank, rest = 0, counts[length]
        while rest:
            at = bisect_left(sizes, length)
            if at == len(sizes):
                break
            gap = sizes[at]
            intervals = gaps[gap]
            first, last = intervals.pop()
            if not intervals:
                del gaps[gap], sizes[at]
            put = fill(length, rank, rest, gap, first, last)
            rank, rest = rank + put, rest - put
        if rest:
            new = -(-rest // (limit // length))
            fill(length, rank, rest, limit, opened, opened + new)
            opened += new
    return found


def pack(pieces: DataFrame, limit: int = LIMIT) -> DataFrame:
    """Add sequence_id and offset to pieces (doc_id, piece, start, length, ...); written once, before."""
    spark = pieces.sparkSession
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # `limit` rows
    plan = sweep(counts, limit)
    ranked = numbered(pieces, ["length"], ["doc_id", "piece", "start"],
                      [F.col("doc_id").asc_nulls_last(), F.col("piece")], "_rank", max(counts.values(), default=0))
    if not plan:
        return ranked.select(*pieces.columns, F.lit(None).cast("bigint").alias("sequence_id"), F.lit(None).cast("bigint").alias("offset"))
    by_length: dict[int, list[tuple]] = {}
    for length, *match in plan:
        by_length.setdefault(length, []).append(tuple(match))
    schema = "length bigint, matches array<struct<rank:bigint,pieces:bigint,first:bigint,each:bigint,offset:bigint>>"
    table = spark.createDataFrame(sorted(by_length.items()), schema)  # at most `limit` rows, one match or more each
    mine = F.filter("matches", lambda m: (m["rank"] <= F.col("_rank")) & (F.col("_rank") < m["rank"] + m["pieces"]))[0]
    inside = F.col("_rank") - F.col("_m.rank")
    placed = ranked.join(F.broadcast(table), "length").withColumn("_m", mine)
    return placed.select(
        *pieces.columns,
        (F.col("_m.first") + F.floor(inside / F.col("_m.each"))).cast("bigint").alias("sequence_id"),
        (F.col("_m.offset") + F.pmod(inside, F.col("_m.each")) * F.col("length")).cast("bigint").alias("offset"))


def pack_documents(docs: DataFrame, tokenizer: str | None = None, limit: int = LIMIT) -> DataFrame:
    """Pieces with their place and the checksum of their ids; token_pieces with `ids` gives the ids themselves."""
    return pack(keep(token_pieces(docs, tokenizer, limit), "pieces"), limit)
