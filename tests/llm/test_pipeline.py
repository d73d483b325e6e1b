"""The pipeline, each stage by brute force on what the one before kept."""

import os
import subprocess
import sys
from collections import Counter

import numpy as np
import test_packing
import test_quality
import test_secrets
import test_simhash

import corpus_pipeline
from tierline.llm import mixing, quality
from tierline.session import stage

SF = "/root/testdata/sf0.001"


def good(text):
    n_words, word_chars, n_symbols, n_dup, n_repeat, failed = test_quality.brute(text)
    if failed:
        return False
    words = test_quality.WORD.findall(text)
    lines = [line for line in text.split("\n") if test_quality.WORD.search(line)]
    stop = {w for ws in quality.STOP_WORDS.values() for w in ws}
    return (
        2 <= word_chars / n_words <= 15 and n_symbols / n_words <= 0.1 and n_dup / len(lines) <= 0.5
        and sum(w.lower() in stop for w in words) / n_words >= 0.02 and n_repeat / n_words <= 0.5
    )


def masked(text):
    covered = np.zeros(len(text) + 1, bool)
    for start, _, end in test_secrets.brute(text):
        covered[start:end] = True
    out, i = [], 0
    while i < len(text):
        if covered[i]:
            out.append("[SECRET]")
            while covered[i]:
                i += 1
        else:
            out.append(text[i])
            i += 1
    return "".join(out)


def test_every_stage(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    raw = {r.doc_id: r for r in docs.collect()}
    steps = dict(corpus_pipeline.STAGES)
    names = [name for name, _ in corpus_pipeline.STAGES]
    kept = stage(steps[names[0]](spark, docs, SF))
    assert kept.columns == docs.columns
    texts = {r.doc_id: r.text for r in kept.collect()}
    assert texts == {k: r.text for k, r in raw.items() if good(r.text)}
    single = stage(steps[names[1]](spark, kept, SF))
    left = set(test_simhash.brute_components({k: test_simhash.brute_fingerprint(t) for k, t in texts.items()}).values())
    assert {r.doc_id for r in single.collect()} == left
    clean = stage(steps[names[2]](spark, single, SF))
    cleaned = {r.doc_id: r.text for r in clean.collect()}
    assert cleaned == {k: masked(texts[k]) for k in left}
    assert all(r.n_chars == len(r.text) for r in clean.collect())
    mixed = stage(steps[names[3]](spark, clean, SF))
    assert mixed.columns == docs.columns
    took = Counter()
    for r in mixed.collect():
        assert cleaned[r.doc_id].startswith(r.text)
        took[r.doc_id] += len(test_quality.WORD.findall(r.text))
    assert +took == +Counter({r.doc_id: r.taken for r in mixing.mixed(clean).collect()})
    from pyspark.sql import functions as F

    packed = steps[names[4]](spark, mixed, SF).withColumn("ids_crc32", F.crc32("ids")).collect()
    bins = test_packing.check(packed, mixed.collect())
    assert bins <= sum(r.length for r in packed) / 4096 + 2
    whole = corpus_pipeline.run(spark, SF)
    assert Counter((r.doc_id, r.piece, r.length) for r in whole.collect()) == Counter((r.doc_id, r.piece, r.length) for r in packed)


def test_empty_table(spark, tmp_path):
    spark.read.parquet(f"{SF}/documents.parquet").limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_entry_goes_without_the_subpackage(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    for name in os.listdir(root):
        if name not in ("tierline", "corpus_pipeline.py", ".git"):
            os.symlink(f"{root}/{name}", tmp_path / name)
    os.mkdir(tmp_path / "tierline")
    for name in os.listdir(f"{root}/tierline"):
        if name != "llm":
            os.symlink(f"{root}/tierline/{name}", tmp_path / "tierline" / name)
    code = "import __spark_entry__ as e; print(len(e.queries()), any(n.startswith('op') and n[2].isdigit() for n in e.queries()))"
    done = subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, env=os.environ | {"PYTHONPATH": str(tmp_path)}, capture_output=True, text=True)
    assert done.returncode == 0 and done.stdout.split()[1] == "False", done.stderr
