"""Short random keys among thousands of ordinary long tokens."""

import random

import pytest

from marquee.llm import secrets

WORDS = """about account archive billing branch catalog center change client column comment config content control
current customer default delivery device document editor element engine export feature filter folder format handler
history import index invoice letter library manager market member message method module network object option order
package payment picture policy product profile project protocol provider public query record region report request
resource result review school screen search section server service session setting shipping source station status
storage student subject summary system target template thread ticket traffic transfer update user value vendor""".split()


def ordinary(rng, n):
    some = [rng.choice(WORDS) for _ in range(12)]
    kind = rng.randrange(4)
    if kind == 0:
        return "".join(w.capitalize() for w in some)[:n]
    if kind == 1:
        return "/".join(some)[:n]
    if kind == 2:
        return "_".join(some)[:n]
    return "-".join(w.capitalize() + (str(rng.randrange(10)) if rng.random() < 0.3 else "") for w in some)[:n]


@pytest.mark.parametrize("length,share,least", [(20, 0.2, 0.6), (20, 0.05, 0.4), (24, 0.05, 0.7), (32, 0.01, 0.8), (40, 0.01, 0.9)])
def test_short_keys_among_ordinary_tokens(spark, length, share, least):
    rng = random.Random(length)
    alphabet = secrets.ENCODINGS["base64"][0][:62]
    keys = int(5000 * share)
    tokens = ["".join(rng.choice(alphabet) for _ in range(length)) for _ in range(keys)]
    tokens += [ordinary(rng, length) for _ in range(5000 - keys)]
    docs = spark.createDataFrame([(i, f"see {t} here") for i, t in enumerate(tokens)], "doc_id bigint, text string")
    hits = [r["doc_id"] for r in secrets.find_secrets(docs).filter("exists(spans, s -> s.kind = 'random')").collect()]
    right = sum(h < keys for h in hits)
    assert right >= least * keys and len(hits) - right <= 0.02 * len(hits) + 2
    masked = {r["doc_id"] for r in secrets.mask_secrets(docs).filter("text = 'see <random> here'").collect()}
    assert masked == set(hits)


def test_counted_and_repeated_tokens_are_no_secrets():
    for token in ("abcdefghijklmnopqrstuvwxyz0123456789", "ABABABABABABABABABABABAB", "internationalisationandsoforthandsoon"):
        assert secrets.score(token) < 1
