"""What a Python worker takes and keeps, measured in a process of its own."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

WORKER = r"""
import re, threading, time
from types import SimpleNamespace as Object

import numpy as np
import public_tokenizers as P
import pyarrow as pa

from tomeflow.llm import bpe

def memory():
    return int(re.search(r"RssAnon:\s+(\d+)", open("/proc/self/status").read())[1]) / 1024

class Docs:
    sparkSession = None
    schema = {"doc_id": Object(dataType=Object(simpleString=lambda: "bigint"))}
    def select(self, *columns):
        return self if len(columns) > 1 else Object(schema=Object(names=["doc_id"]))
    def mapInArrow(self, rows, schema):
        return rows

bpe.small_batches = lambda *_: None
rows = bpe.roundtrip_digests(Docs(), P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)
rng = np.random.default_rng(3)
words = np.array(["".join(map(chr, rng.integers(97, 123, rng.integers(2, 9)))) for _ in range(40_000)])

def batches(n):
    for k in range(n):  # 400 texts of about 2 KB each
        texts = [" ".join(words[rng.integers(0, len(words), 330)]) for _ in range(400)]
        yield pa.RecordBatch.from_arrays([pa.array(range(k * 400, k * 400 + 400), pa.int64()), pa.array(texts)], ["doc_id", "text"])

def run(n):
    return sum(len(b) for b in rows(batches(n)))

run(1)  # the vocabulary is read
before, most, done = memory(), [0], []

def watch():
    while not done:
        most[0] = max(most[0], memory())
        time.sleep(0.01)

watcher = threading.Thread(target=watch)
watcher.start()
count = run(25)
done.append(1)
watcher.join()
print(count, round(most[0] - before), round(memory() - before))
"""


@pytest.mark.skipif(not sys.platform.startswith("linux"), reason="reads /proc")
def test_bpe_takes_little_and_gives_it_back():
    env = os.environ | {"PYTHONPATH": ROOT, "OMP_NUM_THREADS": "1"}
    out = subprocess.run([sys.executable, "-c", WORKER], env=env, cwd=ROOT, capture_output=True, text=True, check=True).stdout
    count, most, kept = map(int, out.split())
    assert count == 10_000
    # MB above what the vocabulary takes; 82 and 36 with groups of 8 MB and without a release.
    assert most < 65
    assert kept < 18
