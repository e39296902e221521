"""SentencePiece parity, license scan and URL filter on literal rows."""

import struct

import numpy as np
import pyarrow as pa
import pytest

from freightmart.llm.licenses import license_scan, license_texts
from freightmart.llm.pieces import PieceCodec, model_file
from freightmart.llm.urls import url_filter

TEXTS = ["", " ", "a", "  a", "a  b", "a ", "Hello world", "\n\n x\ty", "日本 語🦄é", "▁a", "<s> </s> <unk> <0x41>", "\x00a", "x" * 300, "one two one two"]


def unigram_model() -> bytes:
    """A small unigram model with byte fallback, written field by field."""
    def field(number: int, raw: bytes) -> bytes:
        return bytes([number << 3 | 2, len(raw)]) + raw

    def piece(text: str, score: float, kind: int) -> bytes:
        return field(1, field(1, text.encode()) + b"\x15" + struct.pack("<f", score) + bytes([3 << 3, kind]))

    words = [("▁", -3.0), ("▁one", -1.0), ("▁two", -1.5), ("o", -4.0), ("n", -4.0), ("e", -4.0), ("▁o", -2.5), ("ne", -2.0), ("a", -3.5), ("▁a", -3.0)]
    body = piece("<unk>", 0, 2) + piece("<s>", 0, 3) + piece("</s>", 0, 3)
    body += b"".join(piece(f"<0x{i:02X}>", -20.0, 6) for i in range(256)) + b"".join(piece(w, s, 1) for w, s in words)
    trainer = bytes([3 << 3, 1]) + bytes([0x98, 0x02, 1])
    normaliser = field(1, b"identity") + bytes([3 << 3, 1, 4 << 3, 0, 5 << 3, 1])
    return body + field(2, trainer) + field(3, normaliser)


@pytest.fixture(scope="module", params=["bpe", "unigram"])
def model(request, tmp_path_factory):
    if request.param == "bpe":
        return model_file()
    path = tmp_path_factory.mktemp("model") / "unigram.model"
    path.write_bytes(unigram_model())
    return str(path)


def test_parity_and_round_trip(model):
    import sentencepiece

    own, other = PieceCodec(model), sentencepiece.SentencePieceProcessor(model_file=model)
    for text, raw in zip(TEXTS, own.encode(pa.array(TEXTS)), strict=True):
        ids = np.frombuffer(raw, "<u4")
        assert ids.tolist() == other.encode(text), text
        assert own.decode(ids) == other.decode(ids.tolist())


def test_license_scan(llm):
    mit, gpl = "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3."
    files = [
        (1, "a/LICENSE", mit), (2, "a/x.py", "some code of no license"), (3, "a/b/y.py", "more\n" + gpl + "\n" + "code " * 60),
        (4, "a/b/c/z.py", "deep code"), (5, "q/r.py", "alone"), (6, "a/b/c/COPYING", gpl), (7, "top.py", None), (8, None, ""), (9, "a/b/w.py", "under the sea"),
    ]
    got = {r["doc_id"]: (r["license"], r["origin"], r["directory"]) for r in license_scan(llm.createDataFrame(files, "doc_id bigint, path string, text string")).collect()}
    assert got == {
        1: ("MIT", "own", None), 2: ("MIT", "inherited", "a"), 3: ("GPL-3.0", "own", None), 4: ("GPL-3.0", "inherited", "a/b/c"), 5: (None, "none", None),
        6: ("GPL-3.0", "own", None), 7: (None, "none", None), 8: (None, "none", None), 9: ("MIT", "inherited", "a"),
    }


def scanned(llm, *files):
    rows = license_scan(llm.createDataFrame([(i, *f) for i, f in enumerate(files)], "doc_id bigint, path string, text string")).collect()
    return [(r["license"], r["origin"], r["directory"]) for r in sorted(rows, key=lambda r: r["doc_id"])]


def test_licenses_keep_their_versions_and_reserved_rights(llm):
    work = "This work is licensed under the GNU General Public License"
    code = "\n" + "code " * 60
    stated = {
        f"{work}, version 1.": "GPL-1.0", f"{work}, version 2.": "GPL-2.0", f"{work}, version 3.": "GPL-3.0", f"{work}.": "GPL", f"{work}, version 9.": None,
        "This work is licensed under the GNU Lesser General Public License, version 2.1.": "LGPL-2.1", "Licensed under CC BY-NC-SA 4.0.": "CC-BY-NC-SA-4.0",
        "This work is licensed under the GNU Affero General Public License, version 3.": "AGPL-3.0", "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
        "Licensed under the Apache License, Version 1.1.": "Apache-1.1", "Licensed under CC BY 3.0.": "CC-BY-3.0", "Licensed under CC BY-SA 4.0.": "CC-BY-SA-4.0",
        "Licensed under the BSD 2-Clause License.": "BSD-2-Clause", "Licensed under the ISC License.": "ISC", "SPDX-License-Identifier: MPL-2.0": "MPL-2.0",
        "All rights reserved.": "All-Rights-Reserved", "Copyright (c) 2020 Some Body, all rights reserved.": "All-Rights-Reserved",
        "All rights reserved.\nReleased under the MIT License.": "MIT", "Mit.": None,
    }
    assert [x[0] for x in scanned(llm, *((f"d{i}/f", text + code) for i, text in enumerate(stated)))] == list(stated.values())
    assert scanned(llm, ("a/LICENSE", "Released under the MIT License."), ("a/x", "All rights reserved." + code), ("a/b/NOTICE", "All rights reserved."),
                   ("a/b/y", "code"), ("a/z", "Some rights are reserved")) == [
        ("MIT", "own", None), ("All-Rights-Reserved", "own", None), ("All-Rights-Reserved", "own", None), ("All-Rights-Reserved", "inherited", "a/b"),
        ("MIT", "inherited", "a")]


def test_wrapped_headers_and_whole_license_texts(llm):
    code = "\n" + "x = compute(y, z)\n" * 60
    bsd = ("# Redistribution and use in source and binary forms, with or without\n"
           "# modification, are permitted provided that the following conditions are met:\n")
    free = ("/* This program is free software; you can redistribute it and/or\n * modify it under the terms of the GNU General Public License\n"
            " * as published by the Free Software Foundation; either version 2\n * of the License, or (at your option) any later version.\n */")
    apache = ("Licensed under the Apache License, Version 2.0 (the \"License\");\nyou may not use this file except in compliance with the License.\n"
              "You may obtain a copy of the License at\n\n    http://www.apache.org/licenses/LICENSE-2.0\n\nUnless required by applicable law")
    gpl_notice = free[3:-3] + ("\n *\n * This program is distributed in the hope that it will be useful,\n * but WITHOUT ANY WARRANTY; without even the implied warranty of\n"
                               " * MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the\n * GNU General Public License for more details.\n *\n"
                               " * You should have received a copy of the GNU General Public License\n * along with this program; if not, see <http://www.gnu.org/licenses/>.")
    apache_notice = apache + (" or agreed to in writing, software\ndistributed under the License is distributed on an \"AS IS\" BASIS,\nWITHOUT WARRANTIES OR CONDITIONS OF ANY "
                              "KIND, either express or implied.\nSee the License for the specific language governing permissions and\nlimitations under the License.\n")
    assert scanned(llm, ("a/LICENSE", apache_notice), ("a/b", code), ("g/LICENSE", gpl_notice), ("g/b", code)) == [
        ("Apache-2.0", "own", None), ("Apache-2.0", "inherited", "a"), ("GPL-2.0", "own", None), ("GPL-2.0", "inherited", "g")]
    texts = license_texts()
    assert {"MIT", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "MPL-2.0"} <= texts.keys()
    heads = [("h0/x.py", bsd + code), ("h1/x.py", "import os\n\n" + bsd + "\n" + code), ("h2/x.c", free + code), ("h3/x.py", apache + code)]
    files = [(f"{name}/LICENSE", f"Copyright (c) 2021 Some Body. All rights reserved.\n\n{text}") for name, (text,) in texts.items()]
    below = [(f"{name}/src/a.py", code) for name in texts]
    assert scanned(llm, *heads, *files, *below) == [
        ("BSD", "own", None), ("BSD", "own", None), ("GPL-2.0", "own", None), ("Apache-2.0", "own", None),
        *((name, "own", None) for name in texts), *((name, "inherited", name) for name in texts)]


def test_url_filter(llm):
    urls = [
        "http://Shop.NET/x", "https://www.example.net/en/1?x#y", "http://example.com/de/9", "http://a.example.com/fr/", "http://b.org/fr/2", "http://net",
        "nonsense", None, "http://notnet/", "x://y.net/a://z", "http://example.net/english", "http://net?x/",
    ]
    rows = llm.createDataFrame([(i, u, "r", "h") for i, u in enumerate(urls * 2)], "page_id bigint, url string, rule string, html string")
    got = {r["page_id"] % len(urls): (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter(rows).collect()}
    assert got[0] == ("shop.net", "/x", "net/", "block") and got[1] == ("www.example.net", "/en/1", "example.net/en/", "allow")
    assert got[2][2:] == ("example.com/de/", "block") and got[3][2] is None and got[4][2:] == ("org/fr/", "allow")
    assert got[5][:3] == ("net", "", None) and got[6][:3] == ("", "", None) == got[7][:3] and got[8][2] is None
    assert got[9][:3] == ("y.net", "/a://z", "net/")
    assert got[10][2] == "net/" and got[11][:3] == ("net", "", None)
    assert url_filter(rows.limit(0)).collect() == []
    assert {r["verdict"] for r in url_filter(rows.where("url = 'nonsense'")).collect()} == {"allow"}
