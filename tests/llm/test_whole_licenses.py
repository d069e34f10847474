"""Operator 2: entire licences of some length, and spellings in several words."""

from __future__ import annotations

import os
import textwrap

import pytest

from tillroll.llm import license_scan
from tillroll.llm.licenses import BSD_2, BSD_3, MIT, ZERO_BSD, ZLIB

SYSTEM = "/usr/share/common-licenses"


def found(documents, texts):
    return [r.license_id for r in license_scan.scan(documents(list(enumerate(texts)))).orderBy("doc_id").collect()]


@pytest.mark.skipif(not os.path.isdir(SYSTEM), reason="no licence texts on this system")
def test_entire_licenses(documents):
    names = {"Apache-2.0": "Apache-2.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-2.1": "LGPL-2.1", "MPL-2.0": "MPL-2.0", "CC0-1.0": "CC0-1.0"}
    texts = [open(f"{SYSTEM}/{n}", encoding="utf-8").read() for n in names]
    assert found(documents, texts) == list(names.values())
    terms = [texts[i].partition("END OF TERMS")[0].upper() for i in (0, 1, 2)]
    assert found(documents, terms) == ["Apache-2.0", "GPL-2.0", "GPL-3.0"]


def test_spellings_in_several_words(documents):
    mit = MIT.replace("NONINFRINGEMENT", "NON-INFRINGEMENT")
    texts = [mit, mit.replace("sublicense", "sub-license"), BSD_2.replace("COPYRIGHT HOLDER", "COPYRIGHT OWNER"), mit + " not"]
    assert found(documents, texts) == ["MIT", "MIT", "BSD-2-Clause", None]


def wrapped(text, width):
    return "\n\n".join(textwrap.fill(p, width, break_long_words=False) for p in text.split("\n\n"))


def test_headings(documents):
    line = "Copyright (c) 2020, Some Body\nAll rights reserved.\n\n"
    texts = [f"{head}\n\n{line}{text}" for head, text in (
        ("BSD 3-Clause License", BSD_3), ("BSD 2-Clause License", BSD_2), ("zlib License", ZLIB), ("BSD Zero Clause License", ZERO_BSD),
    )]
    texts.append("MIT License\n\nCopyright <YEAR> <COPYRIGHT HOLDER>\n\n" + MIT)
    assert found(documents, texts) == ["BSD-3-Clause", "BSD-2-Clause", "Zlib", "0BSD", "MIT"]


@pytest.mark.skipif(not os.path.isdir(SYSTEM), reason="no licence texts on this system")
@pytest.mark.parametrize("width", [40, 60, 78, 120, 100_000])
def test_wrapped_otherwise(documents, width):
    """The same words in other lines, some of which begin with (c) or copyright."""
    names = {"Apache-2.0": "Apache-2.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-2.1": "LGPL-2.1", "MPL-2.0": "MPL-2.0"}
    texts = [open(f"{SYSTEM}/{n}", encoding="utf-8").read() for n in names]
    texts += ["Copyright (c) 1999 X\n\n" + t for t in (MIT, BSD_2, BSD_3, ZLIB)]
    want = [*names.values(), "MIT", "BSD-2-Clause", "BSD-3-Clause", "Zlib"]
    assert found(documents, [wrapped(t, width) for t in texts]) == want
    # One word less is another text, also in a line that begins with (c).
    less = [texts[0].replace("You must", "You", 1), texts[0].replace("copyright notice", "notice", 1)]
    assert found(documents, less) == [None, None]


def test_what_a_copyright_line_is():
    lines = ["Copyright (c) 2020 X", "(C) 1999-2003 Y", "Copyright 2011 The Z Authors. All rights reserved.", "# © 2020 Q", "All rights reserved.", "copyright [yyyy] [name]", "Copyright (C) <year> <name>"]
    body = ["copyright notice, this list", "COPYRIGHT HOLDERS BE LIABLE", "(c) You must retain", "all rights reserved by others in", "copyright license to reproduce", "(c) the third point"]
    assert all(license_scan.canonical(x) == "" for x in lines) and all(license_scan.canonical(x) for x in body)
    assert license_scan.canonical(lines[0], whole=True) == "copyright c 2020 x"
