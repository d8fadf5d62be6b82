import math

import pytest

from guideloom.llm import licenses
from guideloom.llm.queries import LICENSE_PHRASES

MIT, APACHE = licenses.TEMPLATES[0][1], licenses.TEMPLATES[1][1]


def brute(text):
    words = licenses.words_of(text or "")
    places, labels = [], set()
    for phrase, label in LICENSE_PHRASES:
        p = phrase.split()
        found = [i for i in range(len(words)) if words[i : i + len(p)] == p]
        places += found
        labels |= {label} if found else set()
    more, share = set(), 0.0
    for a in range(0, len(words), 32):
        block = set(words[a : a + 64])
        for label, notice in licenses.TEMPLATES:
            t = set(licenses.words_of(notice))
            if len(t & block) >= math.ceil(0.8 * len(t) - 1e-9):
                more.add(label)
                share = max(share, len(t & block) / len(t))
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)), ",".join(sorted(labels | more)), pytest.approx(1.0 if labels else share, abs=1e-6)


def test_as_by_brute_force(frame, prose):
    texts = [
        None, "", " .,;", "Under the MIT License", "under the mit license under-the-mit-license cc by nc cc/by/nc", "Apache License, Version 2.0 and the apache license version 20", "x under the mit licenses", "é under the mit licenseé",
        prose(200) + " " + MIT + " " + prose(90), " ".join(MIT.split()[::-1]), " ".join(MIT.split()[:20]), " ".join(MIT.split()[:22]) + prose(40, 2), MIT + "\n" + APACHE, *(prose(k, k) + " " + APACHE for k in range(20, 40, 3)), *(n for _, n in licenses.TEMPLATES), MIT + " " + prose(30000, 1),
    ]
    rows = {r["doc_id"]: r for r in licenses.license_scan(frame(texts), LICENSE_PHRASES).collect()}
    for k, text in enumerate(texts):
        r = rows[k]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"], r["labels"], r["score"]) == brute(text), (k, text and text[:80])


def test_odd_tables(frame):
    assert licenses.license_scan(frame([]), LICENSE_PHRASES).collect() == []
    rows = licenses.license_scan(frame([MIT, MIT, None], ids=[1, 1, None]), LICENSE_PHRASES).collect()
    assert sorted((r["doc_id"] or 0, r["labels"]) for r in rows) == [(0, ""), (1, "mit"), (1, "mit")]


def test_stretched_notices_at_any_place(frame, prose):
    words = MIT.split()
    stretched = " ".join(w + " zz" * (k < 21) for k, w in enumerate(words))
    most = max(len(words), 64)
    wide = " ".join([*words[:-1], *["zz"] * (most - len(words)), words[-1]])
    texts = [f"{prose(k, k)} {notice} {prose(40, 7)}" for notice in (stretched, wide) for k in range(1, 34, 4)]
    rows = licenses.license_scan(frame(texts), LICENSE_PHRASES).collect()
    assert len(rows) == len(texts) and all((r["labels"], r["score"]) == ("mit", 1.0) for r in rows)


def test_short_lines(frame, prose):
    lines = {"This work is licensed under the GNU General Public License, version 3.": "gpl", "Released under the MIT License.": "mit", "Licensed under the Apache License, Version 2.0.": "apache-2", "Licensed under CC BY-NC 4.0.": "cc-by-nc", "This work is licensed under the Mozilla Public License, version 2.": ""}
    rows = {r["doc_id"]: r["labels"] for r in licenses.license_scan(frame([f"{prose(90)}\n{x}\n{prose(50, 3)}" for x in lines]), LICENSE_PHRASES).collect()}
    assert rows == dict(enumerate(lines.values()))


def test_templates_longer_than_a_block(frame):
    notice = " ".join(f"word{k}" for k in range(150))
    found = licenses.license_scan(frame([f"before {notice} after", "word1 word2", None]), LICENSE_PHRASES, [("long", notice), *licenses.TEMPLATES]).collect()
    assert {r["doc_id"]: (r["labels"], r["score"]) for r in found} == {0: ("long", 1.0), 1: ("", 0.0), 2: ("", 0.0)}
    with pytest.raises(ValueError):
        licenses.license_scan(frame(["x"]), LICENSE_PHRASES, [("long", notice)], window=64)
