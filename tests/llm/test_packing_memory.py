"""What a packing task holds while it encodes."""

from __future__ import annotations

import random
import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa

from panelloom.llm import packing
from panelloom.llm.arrays import texts
from panelloom.llm.queries import WORD_TOKENIZER


def test_packing_encodes_a_large_batch_in_small_memory():
    pick = random.Random(5)
    words = ["".join(pick.choices("abcdefghij", k=pick.randint(2, 9))) for _ in range(3000)]
    column = pa.array([" ".join(pick.choices(words, k=400)) for _ in range(1800)])
    assert column.nbytes > 4_000_000
    whole = packing.WordTokenizer(public_tokenizers.path(WORD_TOKENIZER))
    expected = [ids.copy() for part in texts(column, 8 << 20) for ids in whole.rows(part)]
    cut = packing.WordTokenizer(public_tokenizers.path(WORD_TOKENIZER))
    found = [ids.copy() for ids in cut.column(column)]  # also warms up what is kept
    tracemalloc.start()
    for _ in cut.column(column):
        pass
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert all(np.array_equal(a, b) for a, b in zip(found, expected, strict=True))
    assert peak < 60_000_000, peak  # 2 MB of text at once took 83 MB, 0.5 MB take 21


def test_both_ways_of_encoding_share_one_model_and_agree():
    encode = packing.WordTokenizer(public_tokenizers.path(WORD_TOKENIZER))
    words = [w for w in encode._whole.get_vocab() if w.isascii() and w.isalpha() and w.islower()][:5000] + ["zzqxj", "straße", "ñandú", "äöü"]
    for word in words:
        assert encode._letters.encode(word, add_special_tokens=False).ids == encode._whole.encode(word, add_special_tokens=False).ids
