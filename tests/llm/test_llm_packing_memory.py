"""What packing remembers of words stays small beside a worker's share of an
executor."""

import os
import subprocess
import sys

import numpy as np
import pyarrow as pa

from ballotlens.llm import packing as P

LIMIT_MB = 45               # objects for each word took 66 to 70 MB, arrays 20 to 21

GROWTH = """
import resource
import numpy as np
import pyarrow as pa
from ballotlens.llm import packing as P

rng, path = np.random.default_rng(1), P.default_tokenizer()
letters = np.frombuffer(b"abcdefghijklmnopqrstuvwxyz", np.uint8)
P.encode_texts(pa.array(["some words"]), path)
peak = lambda: resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024
before = peak()
for _ in range(10):             # 300,000 words, none twice but by chance; no part as large as a slice of texts
    words = letters[rng.integers(0, 26, (30_000, 12))]
    words[:, 10] = ord("0") + rng.integers(0, 10, 30_000)       # not of letters alone
    words[::2, 10:] = ord("x")
    words[:, 11] = ord(" ")
    P.encode_texts(pa.array([words.tobytes().decode()]), path)
print(peak() - before)
"""


def test_memory_of_many_words():
    env = {**os.environ, "PYTHONPATH": os.pathsep.join(sys.path), "OMP_NUM_THREADS": "1"}
    run = subprocess.run([sys.executable, "-c", GROWTH], env=env, capture_output=True, text=True, timeout=300)
    assert run.returncode == 0, run.stderr
    assert int(run.stdout) < LIMIT_MB


def test_words_are_found_again_and_forgotten(monkeypatch):
    monkeypatch.setattr(P, "CACHE_WORDS", 40)
    monkeypatch.setattr(P, "ENCODED_WORDS", 7)
    monkeypatch.setattr(P.C, "CHUNK_BYTES", 64)
    rng = np.random.default_rng(2)
    words = [f"{a}{b}" for a in ("Stake", "vote", "épochs", "x1", "日本", "don't,", "<|endoftext|>") for b in ("", "s", "42", "!", "ing")]
    words_of = P._Words(P.default_tokenizer())
    for _ in range(30):
        texts = [" ".join(rng.choice(words, rng.integers(0, 40))) for _ in range(3)] + [None, ""]
        for text, ids in zip(texts, words_of.encode(pa.array(texts, pa.string()))):
            assert ids.tolist() == words_of.tokenizer.encode(text or "", add_special_tokens=False).ids
        assert (np.diff(words_of.keys.astype(object)) > 0).all() and len(words_of.keys) <= 40 + len(words) * 3
