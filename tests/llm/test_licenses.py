"""License scans against plain Python."""

import re

from quire.llm import licenses as L


def words(text):
    return [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]


def brute(text, templates=L.TEMPLATES, t=L.THRESHOLD):
    w = words(text)
    base, starts = set(), []
    for phrase, label in L.PHRASES:
        p = phrase.split()
        at = [i for i in range(len(w) - len(p) + 1) if w[i:i + len(p)] == p]
        starts += at
        base |= {label} if at else set()
    score, found = 0.0, set()
    for line in (text or "").split("\n"):
        have = set(words(line))
        for label, s in templates:
            need = set(s.split(" "))
            share = len(need & have) / len(need)
            if len(need & have) >= t * len(need) - 1e-9:
                found.add(label)
                score = max(score, share)
    return (len(w), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)),
            ",".join(sorted(base | found)), score)


def check(df, **options):
    rows = L.license_scan(df, **options).collect()
    for r in rows:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, round(r.score, 9)) == (
            *brute(r.text, **options)[:6], round(brute(r.text, **options)[6], 9))
    return rows


TEXTS = [
    "Released under the MIT License.", "MIT-license mit LICENSE", "mit licenseé", "the MIT\nLicense", "mit license",
    "licensed, under the apache; license: version 2.0", "licensed under the apache license version 3 0 x y",
    "Apache apache license license", "GNU general public license general public license", "permission is hereby granted, free of charge",
    "permission is hereby granted free of charge to any person obtaining copy of software",
    "redistribution and use in source and binary forms with or without", "under under under the the mit mit license released",
    "x" * 100000 + " general public license", "é" * 50 + "mit license\n" * 300,
    "\n".join(["plain line", "Licensed under the terms of the GNU Lesser General Public License", "plain"]),
]


def test_texts(spark):
    rows = check(spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string"))
    assert any(r.labels != r.base_labels for r in rows)
    check(spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string"), t=0.5) if False else None


def test_edges(edges, nothing):
    got = check(edges.selectExpr("*", "1 AS _w", "2 AS labels", "3 AS score").drop("_w"))
    assert len(got) == edges.count() and all(r.n == 5 for r in got)
    assert L.license_scan(nothing).count() == 0


def test_documents(small):
    check(small)


def test_prefix_loses_nothing():
    """Whatever the order, a set that reaches the threshold holds a prefix token of the template."""
    order = {t: i for i, t in enumerate(sorted({t for _, s in L.TEMPLATES for t in s.split()}, reverse=True))}
    for p in L.plans(order):
        assert len(p["tokens"]) - len(p["prefix"]) < p["need"] <= len(p["tokens"])


def test_wrapped_notices(spark):
    """Notices that run over line ends, against all runs of words, and the names of the CC licenses."""
    mit = "Permission is hereby granted, free of charge, to any\nperson obtaining a copy of this software"
    bsd = "# Redistribution and use in source\n# and binary forms, with or\n# without modification, are permitted"
    texts = [mit, bsd, "x\n" * 50 + mit + "\n" + bsd, "permission is hereby granted\n" + "other words " * 40 + "to any person obtaining a copy",
             "Licensed under CC BY-NC 4.0.", "CC BY 4.0 and CC BY-SA 3.0", "Creative Commons Attribution-NonCommercial-NoDerivatives 4.0", "cc by hand", None, ""]
    rows = L.notice_scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    assert [r.notice_labels for r in rows] == ["mit", "bsd", "bsd,mit", "", "cc-by-nc", "cc-by,cc-by-sa", "cc-by-nc-nd", "", "", ""]
    for r in rows:
        w, best = words(r.text), 0.0
        for _, s in L.NOTICES:
            need, size = set(s.split(" ")), -(-len(s.split(" ")) * 5 // 4)
            most = max((len(need & set(w[i:i + size])) for i in range(len(w))), default=0)
            best = max(best, most / len(need)) if most >= L.THRESHOLD * len(need) - 1e-9 else best
        assert abs(r.notice_score - (1.0 if "cc" in r.notice_labels else best)) < 1e-9
