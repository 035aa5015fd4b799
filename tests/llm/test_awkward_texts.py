"""Texts that are long or odd enough to break a step: runs of white space, hexadecimal dumps, one id with two texts."""

import random
import time
import zlib
from collections import Counter

import numpy as np

from marquee.llm import packing, secrets, suffix_dedup


def test_packing_of_long_runs(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.default_tokenizer())
    n = 2_000_000
    texts = [" " * n, "\n" * n, "\t" * n, "word" + " " * n + "word", "a" * n, " \n" * (n // 2) + "end"]
    got = Counter((r["doc_id"], r["piece"], r["length"], r["ids_crc32"]) for r in packing.token_pieces(
        spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect())
    want = Counter()
    for i, text in enumerate(texts):
        ids = np.array(tokenizer.encode(text, add_special_tokens=False).ids + [0], dtype="<u4")
        cuts = [0, *range((len(ids) - 1) % 2048 + 1, len(ids) + 1, 2048)]
        want.update((i, k, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:])))
    assert got == want


def test_secrets_in_a_long_dump():
    rng = random.Random(8)
    lines = [f"{rng.getrandbits(256):064x}" for _ in range(300_000)]
    text = "\n".join(lines)  # 20 MB
    start = time.perf_counter()
    base, more = secrets.scan_text(text)
    assert time.perf_counter() - start < 60
    assert len(base) == len(lines) and not more


def test_candidates_next_to_spans_as_by_a_plain_search():
    rng = random.Random(9)
    for _ in range(200):
        parts = [rng.choice([f"{rng.getrandbits(128):032x}", "Ab3" * 9, "token=abcdef12", "x", "AKIA" + "Q" * 18, "Zz9" * 8]) for _ in range(12)]
        text = "".join(p + rng.choice([" ", "/", "=", ""]) for p in parts)
        base, more = secrets.scan_text(text)
        want = [(m.start(), m.end()) for m in secrets.TOKEN.finditer(text) if not any(a < m.end() and m.start() < b for a, _, b in base)]
        assert [(a, b) for a, b, _, _ in more] == want


def test_repeats_under_one_id_with_two_texts(spark):
    rng = random.Random(10)
    letters = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    shared = letters(230)
    rows = [(1, letters(600) + "1" + shared + "2" + letters(628)), (1, shared), (2, letters(700) + "3" + shared), (2, letters(80)), (None, shared), (3, letters(300))]
    got = Counter((r["doc_id"], r["n_bytes"], r["n_removed"], bytes(r["kept"])) for r in suffix_dedup.remove_repeats(
        spark.createDataFrame(rows, "doc_id bigint, text string")).collect())
    want = Counter()
    for doc_id, text in rows:
        kept = text.replace(shared, "").encode()
        want[doc_id, len(text), len(text) - len(kept), kept] += 1
    assert got == want
