import random
import re
from collections import Counter

import numpy as np
import pytest

from rillflow.llm.quality_rules import Limits, keep_good, longest_repeats, quality_rules


def slow(text, limits=Limits()):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)

    def repeated(size):
        windows = [tuple(words[i : i + size]) for i in range(len(words) - size + 1)]
        count = Counter(windows)
        return [i for i, w in enumerate(windows) if count[w] > 1]

    covered = {j for i in repeated(limits.run_words) for j in range(i, i + limits.run_words)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    chars, covered_chars = sum(map(len, words)), sum(len(words[j]) for j in covered)
    failed = len(words) < limits.min_words or 100 * len(covered) > limits.max_repeat_percent * len(words)
    kept = not failed and not repeated(limits.max_run_words + 1) and 100 * covered_chars <= limits.max_covered_percent * chars
    return (len(words), chars, sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), covered_chars, failed, kept)


NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_repeat_chars", "base_failed", "kept"]


@pytest.mark.parametrize("limits", [Limits(), Limits(run_words=3, max_run_words=5, max_covered_percent=90, max_repeat_percent=95, min_words=2)])
def test_edge_rows_against_brute_force(docs, small_docs, limits):
    want = Counter((r[0], *slow(r[1], limits)) for r in small_docs)
    got = quality_rules(docs, limits).collect()
    assert Counter((r.doc_id, *(r[n] for n in NAMES)) for r in got) == want
    kept = keep_good(docs, limits)
    assert kept.columns == docs.columns
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter((r[0], r[1]) for r in small_docs if slow(r[1], limits)[-1])


def test_no_rows(no_docs):
    assert quality_rules(no_docs).collect() == [] and keep_good(no_docs).collect() == []


def test_longest_repeats():
    pick = random.Random(5)
    for _ in range(200):
        docs = [[pick.randrange(3) for _ in range(pick.randrange(30))] for _ in range(4)]
        words = np.array([w for d in docs for w in d], np.int64)
        owner = np.repeat(np.arange(4), [len(d) for d in docs])
        want = []
        for d in docs:
            for i in range(len(d)):
                best = 0
                for j in range(len(d)):
                    k = 0
                    while j != i and max(i, j) + k < len(d) and d[i + k] == d[j + k]:
                        k += 1
                    best = max(best, k)
                want.append(best)
        got = longest_repeats(words, owner, 1).tolist()
        assert got == want
        enough = longest_repeats(words, owner, 4).tolist()
        assert [g if g >= 4 else 0 for g in enough] == [w if w >= 4 else 0 for w in want]
