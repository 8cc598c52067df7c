from __future__ import annotations

from cases import frame, odd_documents, plain_words, prose

from stratamart.llm import licenses

EXTRA = {"one-word": "Zzyzx", "empty": ""}


def plain(text, templates):
    """All windows of all sizes, without bands."""
    words, best = plain_words(text), {}
    pairs = [tuple(words[at : at + 2]) for at in range(len(words) - 1)] or ([tuple(words)] if words else [])
    pairs += pairs[-1:] if len(words) > 1 else []
    for name, template in templates.items():
        wanted = plain_words(template)
        shingles = {tuple(wanted[at : at + 2]) for at in range(len(wanted) - 1)} or {tuple(wanted)}
        if not wanted:
            continue
        size = licenses.SMALLEST
        while size < 2 * len(wanted):
            size *= 2
        for start in range(0, len(words), size // 2):
            share = len(shingles & set(pairs[start : start + size])) / len(shingles)
            if share >= (0.8 if len(shingles) >= 10 else 1) and share > best.get(name, (0, 0))[0]:
                best[name] = (share, start)
    return [(name, *found) for name, found in sorted(best.items())]


def test_notices_in_odd_documents(spark):
    templates = licenses.TEMPLATES | EXTRA
    rows = odd_documents()
    for at, (name, text) in enumerate(templates.items()):
        words = text.split()
        rows.append((1000 + at, f"{prose(at, 37 * at)} {text}. {prose(at, 20)}"))
        rows.append((1100 + at, f"{prose(at, 11)} {' '.join(words[len(words) // 9 :])}"))
        rows.append((1200 + at, f"{prose(at, 11)} {' '.join(words[: len(words) // 2])}"))
    found = licenses.license_matches(frame(spark, rows), templates).collect()
    wanted = sorted((repr(i), [(name, at) for name, _, at in plain(text, templates)]) for i, text in rows)
    assert sorted((repr(r.doc_id), [(m.license, m.first_word) for m in r.matches]) for r in found) == wanted
    by_id = {r.doc_id: r for r in found}
    for at, name in enumerate(templates):
        if name not in EXTRA:
            assert name in by_id[1000 + at].licenses.split(",")
    assert all(r.n_licenses == len(r.matches) for r in found)


def test_bands_retrieve_what_windows_contain():
    smallest = 0.19
    assert 1 - (1 - smallest) ** licenses.BANDS > 0.999998


def test_whole_texts_equal_a_scan_of_all_windows(spark):
    """Templates of up to thousands of words, cut so that more or less than the share asked for is left."""
    texts = licenses.whole_texts()
    rows = [(0, "\n".join(texts[name] for name in sorted(texts)))]
    for at, name in enumerate(["GPL-3.0-text", "Apache-2.0-text", "MPL-2.0-text", "BSD-3-Clause-text", "LGPL-3.0-text"], 1):
        words = texts[name].split()
        for of, share in enumerate((0.7, 0.9)):
            rows.append((10 * at + of, f"{prose(at, 211 * at)} {' '.join(words[: int(share * len(words))])} {prose(at, 40)}"))
    found = licenses.license_matches(frame(spark, rows)).collect()
    wanted = {i: [(name, round(share, 9), at) for name, share, at in plain(text, licenses.TEMPLATES | texts)] for i, text in rows}
    assert {r.doc_id: [(m.license, round(m.containment, 9), m.first_word) for m in r.matches] for r in found} == wanted
    by_id = {i: [name for name, _, _ in matches] for i, matches in wanted.items()}
    assert set(texts) <= set(by_id[0]) and "GPL-3.0-text" in by_id[11] and "GPL-3.0-text" not in by_id[10]


def test_whole_texts(spark):
    texts = licenses.whole_texts()
    assert {"Apache-2.0-text", "GPL-3.0-text", "LGPL-2.1-text", "MPL-2.0-text", "Unlicense-text", "ISC-whole-text"} <= set(texts)
    names = sorted(texts)
    rows = [(at, f"{prose(at, 137 * at)} {texts[name]} {prose(at, 50)}") for at, name in enumerate(names)]
    rows += [(100 + at, " ".join(texts[name].split()[len(texts[name].split()) // 2 :])) for at, name in enumerate(names)]
    found = {r.doc_id: r for r in licenses.license_matches(frame(spark, rows)).collect()}
    for at, name in enumerate(names):
        assert {m.license: m.containment for m in found[at].matches}[name] == 1
        assert name not in found[100 + at].licenses.split(",")


def test_any_number_of_templates(spark):
    templates = {f"t{at}": f"a{at} b{at} c{at} d{at}" for at in range(1500)}
    rows = [(at, f"{prose(at, 30)} {templates[f't{at}']} {prose(at, 9)} {templates['t3']}") for at in range(0, 1500, 100)]
    for row in licenses.license_matches(frame(spark, rows), templates).collect():
        assert set(row.licenses.split(",")) == {f"t{row.doc_id}", "t3"}


def test_empty_table(spark):
    assert licenses.license_matches(frame(spark, [])).collect() == []
