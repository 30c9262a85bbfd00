"""Memory of the driver's Python that the classifier takes and leaves."""

import os
import subprocess
import sys

import numpy as np

from tsforge.llm import pu_classifier

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
TRAIN = """
import random, re
from tsforge.llm import pu_classifier as pu

def held():
    with open("/proc/self/smaps_rollup") as f:
        return sum(map(int, re.findall(r"\\n(?:Private_Dirty|Shared_Dirty):\\s+(\\d+)", f.read()))) / 1024

def texts(docs, ids, limit):
    r = random.Random(limit)
    return [" ".join(f"w{int(r.random() ** 2 * 20000)}" for _ in range(400)) for _ in range(limit)]

def spied(pos, unl, **k):
    seen.append(held())
    return real(pos, unl, steps=2, **k)

seen, real = [], pu.fit
pu.sample_texts, pu.moments, pu.fit = texts, lambda docs: None, spied
pu.train(None, None, 20, 40)  # what is loaded and kept by a first call
before = held()
pu.train(None, None, 1000, 2000)
print(round(seen[-1] - before), round(held() - before))
"""


def test_training_leaves_no_memory_on_the_driver():
    done = subprocess.run([sys.executable, "-c", TRAIN], capture_output=True, text=True, cwd=REPO, timeout=300,
                          env=os.environ | {"PYTHONPATH": REPO, "OMP_NUM_THREADS": "1"})
    assert done.returncode == 0, done.stderr[-2000:]
    fitting, after = map(int, done.stdout.split())
    assert fitting < 36  # 1.2 million words: 26 MB, with all texts 44
    assert after < 8


def test_rows_in_blocks_equal_rows_one_by_one():
    texts = [f"a b{i % 5} c{i} a. {'x ' * (i % 9)}" for i in range(600)] + [""]
    got = pu_classifier.Rows(texts)
    each = [pu_classifier.features(t) for t in texts]
    assert got.n == len(texts) and got.dense.tolist() == [e[0].tolist() for e in each]
    assert got.row.tolist() == np.repeat(np.arange(len(texts)), [len(e[1]) for e in each]).tolist()
    assert got.bin.tolist() == np.concatenate([e[1] for e in each]).tolist()
    assert got.share.tolist() == np.concatenate([e[2] for e in each]).tolist()
    none = pu_classifier.Rows([])
    assert none.n == 0 and none.dense.shape == (0, pu_classifier.N_DENSE) and none.row.dtype == none.bin.dtype == np.int64
    model = pu_classifier.Model(got.dense.mean(0), got.dense.std(0) + 1e-6)
    model.w[:] = np.random.default_rng(3).normal(size=len(model.w))
    words = np.bincount(got.row, got.share * model.w[pu_classifier.N_DENSE + got.bin], minlength=got.n)
    assert (model.margin(got) == model._z(got) @ model.w[:pu_classifier.N_DENSE] + words + model.w[-1]).all()
