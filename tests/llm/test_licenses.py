import random
import re

import pytest

from tillstar.llm import licenses


def pairs(text):
    words = [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]
    return list(zip(words, words[1:]))


KNOWN = [(name, pairs(text)) for name, text in licenses.NOTICES]


def brute_force(text):
    """Every window of every notice's length over the whole text, those that hang over its end included."""
    own, matched = pairs(text), []
    for number, (name, notice) in enumerate(KNOWN):
        different, m, best = set(notice), len(notice), None
        for start in range(len(own)):
            window = own[start : start + m]
            shared = [p for p in window if p in different]
            c, foreign = len(set(shared)), m - len(shared)
            if shared and window[0] in different and 200 * c >= licenses.PERCENT * (c + foreign + len(different)):
                best = max(best or (0, 0, 0), (2 * c / (c + foreign + len(different)), c, -start))
        if best:
            matched.append((-best[1], -best[0], number, -best[2], m, name))
    matched.sort()
    kept = [x for i, x in enumerate(matched) if not any(y[3] < x[3] + x[4] and x[3] < y[3] + y[4] for y in matched[:i])]
    first = matched[0] if matched else None
    return (first[5], -first[1], first[3], len(kept), ",".join(sorted({x[5] for x in kept}))) if first else (None, None, None, 0, "")


GRANT, GPL3 = licenses.NOTICES[3][1], licenses.NOTICES[7][1]
BSD2, BSD3 = (next(t for n, t in reversed(licenses.NOTICES) if n == name and "SPDX" not in t) for name in ("BSD-2-Clause", "BSD-3-Clause"))
FILLER = "the of and to in a software license this is provided under version rights".split()


def mixed(seed):
    """Prose of frequent words of the notices, with pieces of notices between."""
    rng, out = random.Random(seed), []
    for _ in range(6):
        out += rng.choices(FILLER, k=rng.randrange(30))
        words = rng.choice(licenses.NOTICES)[1].split()
        out += [w for w in words if rng.random() > rng.choice([0, 0.05, 0.15])]
    return " ".join(out)


TEXTS = [
    None, "", "\n\n", "word", "license", "some prose\nReleased under the MIT License.", "RELEASED   under the mit-license", "Licensed under CC BY 4.0", "Licensed under CC BY-NC 4.0!",
    "All rights reserved. All rights reserved.", "all rights", GRANT.replace(" to ", "\nto "), "a\n\n" + GRANT.replace(",", "\n") + "\n \nb", GRANT + " and some more words here",
    "All rights reserved.\nReleased under the MIT License.\nAll Rights Reserved", "x " * 50000 + "\nAll rights reserved.", BSD2, BSD3, BSD3 + "\n" + BSD2, BSD3[:-200], BSD3[200:],
    # a notice across two blocks of positions, and one that ends with the text
    "y " * (licenses.BLOCK - 20) + GRANT + " z" * 200, "y " * (2 * licenses.BLOCK - 1) + "All rights reserved", "reserved " * 9000, *map(mixed, range(25)),
]


def told(spark, texts):
    docs = spark.createDataFrame([(i, t, "clash", 1.0) for i, t in enumerate(texts)], "doc_id long, text string, license string, dice double")
    return {r.doc_id: (r.license, r.dice, r.first_word, r.n_notices, r.licenses) for r in licenses.scan(docs).collect()}


def test_equals_brute_force(spark):
    assert told(spark, TEXTS) == {i: brute_force(t) for i, t in enumerate(TEXTS)}


def test_empty_table(spark):
    assert told(spark, [(None)] * 2) == {0: (None, None, None, 0, ""), 1: (None, None, None, 0, "")}
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert licenses.scan(docs).count() == 0


def test_small_blocks_give_the_same(spark, monkeypatch):
    expected = {i: brute_force(t) for i, t in enumerate(TEXTS[-25:])}
    monkeypatch.setattr(licenses, "BLOCK", max(len(p) for _, p in KNOWN))
    assert told(spark, TEXTS[-25:]) == expected


def test_notices_with_other_words_around(spark):
    header = "\n".join(f" * {line}" for line in re.findall(r".{1,60}(?: |$)", "Copyright (C) 2020 Example. " + GPL3 + " See the file COPYING for more."))
    found = told(spark, [
        "Copyright 2021 Example. All rights reserved.", "See LICENSE; this code is released under the MIT License. Enjoy it.", "// SPDX-License-Identifier: Apache-2.0",
        f"/*\n{header}\n */\nint main() {{}}", "#!/bin/sh\n# SPDX-License-Identifier: GPL-2.0-only\necho", BSD2, BSD3, "he walked under the bridge and all was right",
    ])
    assert [found[i][0] for i in range(8)] == ["proprietary", "MIT", "Apache-2.0", "GPL-3.0", "GPL-2.0-only", "BSD-2-Clause", "BSD-3-Clause", None]
    assert [found[i][4] for i in (2, 3, 4, 5, 6)] == ["Apache-2.0", "GPL-3.0", "GPL-2.0-only", "BSD-2-Clause", "BSD-3-Clause"]
    assert found[0][1] == found[1][1] == found[2][1] == 1.0 and found[1][2] == 5


@pytest.mark.parametrize("number", range(0, len(licenses.NOTICES), 3))
def test_every_match_holds_a_telling_word(number):
    telling, notice = set(licenses.telling_words()), KNOWN[number][1]
    without = {p for p in notice if not telling & set(p)}
    assert len(without) < licenses.least_shared(len(set(notice)))


def test_rows_that_share_an_id(spark):
    docs = spark.createDataFrame([(1, "All rights reserved."), (1, "x"), (1, "All rights reserved."), (None, "All rights reserved."), (None, None)], "doc_id long, text string")
    found = sorted(((r.doc_id, r.license, r.n_notices) for r in licenses.scan(docs).collect()), key=str)
    assert found == [(1, "proprietary", 1), (1, "proprietary", 1), (1, None, 0), (None, "proprietary", 1), (None, None, 0)]
