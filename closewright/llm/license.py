"""Licence recognition by sentence rules.

A text is read as normalised words: folded by NFKC and lower case, without punctuation, comment marks and list numbers.
Known sentences are found in them by a hash of their first words, wherever a piece of the text (a line, or what follows
an end mark) begins, and become identifiers; rules are ordered sequences of identifiers, and the longest rule that
matches at a place names the licence there.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Known licence sentences as normalised words; {v} stands for a version, {id} for an identifier and {*} for
# one to SLOT words.
SENTENCES = {
    "mit-title": ("the mit license", "mit license", "the mit license mit", "mit license mit"),
    "mit-released": ("released under the mit license", "licensed under the mit license", "this project is licensed under the mit license", "distributed under the mit license", "this software is released under the mit license", "licensed under the mit license see license file for details"),
    "mit-grant": ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and/or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",),
    "mit-0-grant": ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and/or sell copies of the software and to permit persons to whom the software is furnished to do so",),
    "mit-notice": ("the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", "the above copyright notice and this permission notice including the next paragraph shall be included in all copies or substantial portions of the software"),
    "mit-warranty": ("the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",),
    "mit-liability": ("in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software",),
    "x11-names": ("except as contained in this notice the name of {*} shall not be used in advertising or otherwise to promote the sale use or other dealings in this software without prior written authorization from {*}", "except as contained in this notice the names of {*} shall not be used in advertising or otherwise to promote the sale use or other dealings in this software without prior written authorization"),
    "apache-title": ("apache license version {v}", "apache license version {v} january 2004"),
    "apache-licensed": ("licensed under the apache license version {v}", "licensed under the apache license version {v} the license", "licensed under the apache license version {v} the license you may not use this file except in compliance with the license", "released under the apache license version {v}", "licensed under the apache license {v}", "this project is licensed under the apache license version {v}"),
    "apache-foundation": ("licensed to the apache software foundation asf under one or more contributor license agreements",),
    "apache-asf": ("the asf licenses this file to you under the apache license version {v} the license", "the asf licenses this file to you under the apache license version {v} the license you may not use this file except in compliance with the license"),
    "apache-use": ("you may not use this file except in compliance with the license",),
    "apache-copy": ("you may obtain a copy of the license at http://www.apache.org/licenses/license-{v}", "you may obtain a copy of the license at https://www.apache.org/licenses/license-{v}"),
    "apache-warranty": ("unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",),
    "apache-limits": ("see the license for the specific language governing permissions and limitations under the license",),
    "gpl-licensed": ("this work is licensed under the gnu general public license version {v}", "licensed under the gnu general public license version {v}", "licensed under the gnu general public license {v}", "this program is licensed under the gnu general public license version {v}", "gnu general public license version {v}"),
    "gpl-grant": ("this program is free software you can redistribute it and/or modify it under the terms of the gnu general public license as published by the free software foundation either version {v} of the license or at your option any later version", "{*} is free software you can redistribute it and/or modify it under the terms of the gnu general public license as published by the free software foundation either version {v} of the license or at your option any later version", "this program is free software you can redistribute it and/or modify it under the terms of the gnu general public license version {v} as published by the free software foundation", "this program is free software you can redistribute it and/or modify it under the terms of the gnu general public license version {v} only as published by the free software foundation"),
    "gpl-warranty": ("this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose", "{*} is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose"),
    "gpl-details": ("see the gnu general public license for more details",),
    "gpl-received": ("you should have received a copy of the gnu general public license along with this program", "you should have received a copy of the gnu general public license along with this program if not see http://www.gnu.org/licenses", "you should have received a copy of the gnu general public license along with this program if not see https://www.gnu.org/licenses"),
    "lgpl-licensed": ("licensed under the gnu lesser general public license version {v}", "this work is licensed under the gnu lesser general public license version {v}", "gnu lesser general public license version {v}"),
    "lgpl-grant": ("this library is free software you can redistribute it and/or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version {v} of the license or at your option any later version", "this program is free software you can redistribute it and/or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version {v} of the license or at your option any later version", "this library is free software you can redistribute it and/or modify it under the terms of the gnu library general public license as published by the free software foundation either version {v} of the license or at your option any later version", "{*} is free software you can redistribute it and/or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version {v} of the license or at your option any later version"),
    "lgpl-warranty": ("this library is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",),
    "lgpl-details": ("see the gnu lesser general public license for more details",),
    "agpl-licensed": ("licensed under the gnu affero general public license version {v}", "this work is licensed under the gnu affero general public license version {v}", "gnu affero general public license version {v}"),
    "agpl-grant": ("this program is free software you can redistribute it and/or modify it under the terms of the gnu affero general public license as published by the free software foundation either version {v} of the license or at your option any later version", "{*} is free software you can redistribute it and/or modify it under the terms of the gnu affero general public license as published by the free software foundation either version {v} of the license or at your option any later version"),
    "agpl-details": ("see the gnu affero general public license for more details",),
    "mpl-notice": ("this source code form is subject to the terms of the mozilla public license v {v}", "licensed under the mozilla public license version {v}", "this work is licensed under the mozilla public license version {v}", "the contents of this file are subject to the mozilla public license version {v} the license", "the contents of this file are subject to the mozilla public license version {v} the license you may not use this file except in compliance with the license"),
    "mpl-copy": ("if a copy of the mpl was not distributed with this file you can obtain one at http://mozilla.org/mpl/{v}", "if a copy of the mpl was not distributed with this file you can obtain one at https://mozilla.org/mpl/{v}"),
    "epl-notice": ("this program and the accompanying materials are made available under the terms of the eclipse public license v{v} which accompanies this distribution and is available at {*}", "this program and the accompanying materials are made available under the terms of the eclipse public license {v} which is available at {*}", "licensed under the eclipse public license version {v}", "all rights reserved this program and the accompanying materials are made available under the terms of the eclipse public license {v}"),
    "cddl-notice": ("the contents of this file are subject to the terms of the common development and distribution license the license", "licensed under the common development and distribution license version {v}"),
    "eupl-notice": ("licensed under the eupl version {v}", "licensed under the eupl version {v} or as soon they will be approved by the european commission subsequent versions of the eupl the licence"),
    "bsd-grant": ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "redistribution and use in source and binary forms with or without modification are permitted subject to the limitations in the disclaimer below provided that the following conditions are met"),
    "bsd-source": ("redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",),
    "bsd-binary": ("redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution",),
    "bsd-advertising": ("all advertising materials mentioning features or use of this software must display the following acknowledgement this product includes software developed by {*}", "all advertising materials mentioning features or use of this software must display the following acknowledgement"),
    "bsd-names": ("neither the name of {*} nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission", "neither the names of {*} nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission", "the name of the author may not be used to endorse or promote products derived from this software without specific prior written permission", "the names of its contributors may not be used to endorse or promote products derived from this software without specific prior written permission"),
    "bsd-warranty": ("this software is provided by {*} as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed",),
    "bsd-licensed": ("released under the bsd license", "licensed under the bsd license", "use of this source code is governed by a bsd-style license that can be found in the license file", "licensed under the bsd {v}-clause license", "released under the bsd {v}-clause license"),
    "isc-title": ("isc license", "the isc license"),
    "isc-grant": ("permission to use copy modify and/or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies", "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    "0bsd-grant": ("permission to use copy modify and/or distribute this software for any purpose with or without fee is hereby granted",),
    "isc-warranty": ("the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness",),
    "unlicense-domain": ("this is free and unencumbered software released into the public domain",),
    "unlicense-anyone": ("anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non-commercial and by any means",),
    "wtfpl": ("do what the fuck you want to public license", "do what the fuck you want to public license version {v} december 2004", "you just do what the fuck you want to"),
    "zlib-warranty": ("this software is provided as-is without any express or implied warranty", "this software is provided as-is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software"),
    "zlib-liable": ("in no event will the authors be held liable for any damages arising from the use of this software",),
    "zlib-grant": ("permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions",),
    "zlib-origin": ("the origin of this software must not be misrepresented you must not claim that you wrote the original software", "the origin of this software must not be misrepresented"),
    "boost-title": ("boost software license version {v}", "distributed under the boost software license version {v}", "use modification and distribution are subject to the boost software license version {v}"),
    "boost-grant": ("permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license the software to use reproduce display distribute execute and transmit the software and to prepare derivative works of the software and to permit third-parties to whom the software is furnished to do so all subject to the following",),
    "artistic": ("the artistic license {v}", "artistic license {v}", "licensed under the artistic license {v}", "this program is free software you can redistribute it and/or modify it under the terms of the artistic license {v}"),
    "perl-same": ("this program is free software you can redistribute it and/or modify it under the same terms as perl itself", "this library is free software you can redistribute it and/or modify it under the same terms as perl itself"),
    "python-title": ("python software foundation license version {v}", "psf license agreement for python {v}", "licensed to psf under a contributor agreement"),
    "postgresql-grant": ("permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted provided that the above copyright notice and this paragraph and the following two paragraphs appear in all copies",),
    "hpnd-grant": ("permission to use copy modify distribute and sell this software and its documentation for any purpose is hereby granted without fee provided that the above copyright notice appear in all copies and that both that copyright notice and this permission notice appear in supporting documentation", "permission to use copy modify and distribute this software and its documentation for any purpose and without fee is hereby granted provided that the above copyright notice appear in all copies and that both that copyright notice and this permission notice appear in supporting documentation"),
    "openssl-ack": ("this product includes software developed by the openssl project for use in the openssl toolkit http://www.openssl.org", "this product includes software developed by the openssl project for use in the openssl toolkit"),
    "ms-pl": ("this license governs use of the accompanying software", "microsoft public license ms-pl"),
    "ofl-title": ("sil open font license version {v}", "this font software is licensed under the sil open font license version {v}", "licensed under the sil open font license version {v}"),
    "ncsa-title": ("university of illinois/ncsa open source license",),
    "cecill": ("this software is governed by the cecill license under french law and abiding by the rules of distribution of free software", "licensed under the cecill license version {v}"),
    "ecl-notice": ("licensed under the educational community license version {v} the license", "licensed under the educational community license version {v}"),
    "afl-notice": ("licensed under the academic free license version {v}",),
    "osl-notice": ("licensed under the open software license version {v}",),
    "odbl-notice": ("this database is made available under the open database license", "licensed under the open database license version {v}", "made available under the open database license {v}"),
    "gfdl-grant": ("permission is granted to copy distribute and/or modify this document under the terms of the gnu free documentation license version {v} or any later version published by the free software foundation", "licensed under the gnu free documentation license version {v}"),
    "cc-by-nc": ("licensed under cc by-nc {v}", "this work is licensed under cc by-nc {v}", "licensed under a creative commons attribution-noncommercial {v} international license", "this work is licensed under a creative commons attribution-noncommercial {v} international license", "creative commons attribution-noncommercial {v} international", "this work is licensed under the creative commons attribution-noncommercial {v} international license"),
    "cc-by-nc-sa": ("licensed under cc by-nc-sa {v}", "this work is licensed under cc by-nc-sa {v}", "this work is licensed under a creative commons attribution-noncommercial-sharealike {v} international license", "creative commons attribution-noncommercial-sharealike {v} international", "this work is licensed under the creative commons attribution-noncommercial-sharealike {v} international license"),
    "cc-by-nc-nd": ("licensed under cc by-nc-nd {v}", "this work is licensed under cc by-nc-nd {v}", "this work is licensed under a creative commons attribution-noncommercial-noderivatives {v} international license", "creative commons attribution-noncommercial-noderivatives {v} international", "this work is licensed under the creative commons attribution-noncommercial-noderivatives {v} international license"),
    "cc-by-nd": ("licensed under cc by-nd {v}", "this work is licensed under cc by-nd {v}", "this work is licensed under a creative commons attribution-noderivatives {v} international license", "creative commons attribution-noderivatives {v} international"),
    "cc-by-sa": ("licensed under cc by-sa {v}", "this work is licensed under cc by-sa {v}", "this work is licensed under a creative commons attribution-sharealike {v} international license", "creative commons attribution-sharealike {v} international", "this work is licensed under the creative commons attribution-sharealike {v} international license"),
    "cc-by": ("licensed under cc by {v}", "this work is licensed under cc by {v}", "this work is licensed under a creative commons attribution {v} international license", "creative commons attribution {v} international", "creative commons attribution {v} international license", "this work is licensed under the creative commons attribution {v} international license"),
    "cc0": ("released under cc0 {v}", "licensed under cc0 {v}", "cc0 {v} universal", "creative commons zero {v} universal", "to the extent possible under law {*} has waived all copyright and related or neighboring rights to this work", "to the extent possible under law {*} has waived all copyright and related or neighboring rights to {*}"),
    "spdx": ("spdx-license-identifier {id}",),
}


@dataclass(frozen=True)
class Rule:
    """Sentence identifiers that name a licence when they follow one another."""

    license: str
    sentences: tuple[str, ...]


_APACHE = ("apache-use", "apache-copy", "apache-warranty", "apache-limits")
_BSD = ("bsd-grant", "bsd-source", "bsd-binary")
# Ordered rules; of those that match at a place, the longest and then the first wins.
RULES = (
    Rule("mit", ("mit-title", "mit-grant", "mit-notice", "mit-warranty", "mit-liability")), Rule("mit", ("mit-grant", "mit-notice", "mit-warranty", "mit-liability")), Rule("mit", ("mit-title", "mit-grant", "mit-notice", "mit-warranty")),
    Rule("mit", ("mit-grant", "mit-notice", "mit-warranty")), Rule("mit", ("mit-grant", "mit-notice")), Rule("mit", ("mit-grant",)), Rule("mit", ("mit-released",)), Rule("mit", ("mit-title",)),
    Rule("x11", ("mit-grant", "mit-notice", "mit-warranty", "mit-liability", "x11-names")), Rule("mit-0", ("mit-0-grant", "mit-warranty", "mit-liability")), Rule("mit-0", ("mit-0-grant", "mit-warranty")),
    Rule("apache", ("apache-licensed", *_APACHE)), Rule("apache", ("apache-foundation", "apache-asf", *_APACHE)), Rule("apache", ("apache-foundation", "apache-asf", *_APACHE[1:])), Rule("apache", ("apache-licensed", *_APACHE[1:])),
    Rule("apache", ("apache-licensed", "apache-copy", "apache-warranty")), Rule("apache", ("apache-licensed", "apache-use", "apache-copy", "apache-warranty")), Rule("apache", ("apache-licensed", "apache-use", "apache-copy")), Rule("apache", ("apache-licensed", "apache-copy")), Rule("apache", ("apache-licensed", "apache-use")),
    Rule("apache", ("apache-licensed",)), Rule("apache", ("apache-asf",)), Rule("apache", ("apache-title",)),
    Rule("gpl", ("gpl-grant", "gpl-warranty", "gpl-details", "gpl-received")), Rule("gpl", ("gpl-grant", "gpl-warranty", "gpl-details")), Rule("gpl", ("gpl-grant", "gpl-warranty")), Rule("gpl", ("gpl-licensed",)), Rule("gpl", ("gpl-grant",)),
    Rule("lgpl", ("lgpl-grant", "lgpl-warranty", "lgpl-details")), Rule("lgpl", ("lgpl-grant", "gpl-warranty", "lgpl-details")), Rule("lgpl", ("lgpl-grant", "lgpl-warranty")), Rule("lgpl", ("lgpl-grant", "gpl-warranty")), Rule("lgpl", ("lgpl-grant",)), Rule("lgpl", ("lgpl-licensed",)),
    Rule("agpl", ("agpl-grant", "gpl-warranty", "agpl-details")), Rule("agpl", ("agpl-grant", "gpl-warranty")), Rule("agpl", ("agpl-grant",)), Rule("agpl", ("agpl-licensed",)),
    Rule("mpl", ("mpl-notice", "mpl-copy")), Rule("mpl", ("mpl-notice",)), Rule("epl", ("epl-notice",)), Rule("cddl", ("cddl-notice",)), Rule("eupl", ("eupl-notice",)),
    Rule("bsd-4-clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-advertising", "bsd-names", "bsd-warranty")), Rule("bsd-4-clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-advertising", "bsd-names")),
    Rule("bsd-3-clause", (*_BSD, "bsd-names", "bsd-warranty")), Rule("bsd-3-clause", (*_BSD, "bsd-names")), Rule("bsd-2-clause", (*_BSD, "bsd-warranty")), Rule("bsd-2-clause", _BSD), Rule("bsd-1-clause", ("bsd-grant", "bsd-source", "bsd-warranty")),
    Rule("openssl", (*_BSD, "bsd-advertising", "openssl-ack")), Rule("openssl", ("openssl-ack",)), Rule("ncsa", ("ncsa-title",)), Rule("bsd", ("bsd-grant",)), Rule("bsd", ("bsd-licensed",)),
    Rule("isc", ("isc-title", "isc-grant", "isc-warranty")), Rule("isc", ("isc-grant", "isc-warranty")), Rule("isc", ("isc-grant",)), Rule("isc", ("isc-title",)), Rule("0bsd", ("0bsd-grant", "isc-warranty")), Rule("0bsd", ("0bsd-grant",)),
    Rule("unlicense", ("unlicense-domain", "unlicense-anyone")), Rule("unlicense", ("unlicense-domain",)), Rule("wtfpl", ("wtfpl",)),
    Rule("zlib", ("zlib-warranty", "zlib-liable", "zlib-grant", "zlib-origin")), Rule("zlib", ("zlib-warranty", "zlib-grant", "zlib-origin")), Rule("zlib", ("zlib-warranty", "zlib-liable", "zlib-grant")), Rule("zlib", ("zlib-warranty", "zlib-grant")), Rule("zlib", ("zlib-grant",)),
    Rule("bsl", ("boost-title", "boost-grant")), Rule("bsl", ("boost-title",)), Rule("bsl", ("boost-grant",)), Rule("artistic", ("artistic",)), Rule("artistic", ("perl-same",)), Rule("python", ("python-title",)), Rule("postgresql", ("postgresql-grant",)), Rule("hpnd", ("hpnd-grant",)),
    Rule("ms-pl", ("ms-pl",)), Rule("ofl", ("ofl-title",)), Rule("cecill", ("cecill",)), Rule("ecl", ("ecl-notice",)), Rule("afl", ("afl-notice",)), Rule("osl", ("osl-notice",)), Rule("odbl", ("odbl-notice",)), Rule("gfdl", ("gfdl-grant",)),
    Rule("cc-by-nc-sa", ("cc-by-nc-sa",)), Rule("cc-by-nc-nd", ("cc-by-nc-nd",)), Rule("cc-by-nc", ("cc-by-nc",)), Rule("cc-by-nd", ("cc-by-nd",)), Rule("cc-by-sa", ("cc-by-sa",)), Rule("cc-by", ("cc-by",)), Rule("cc0", ("cc0",)),
    Rule("spdx", ("spdx",)),
)
#: Most words that {*} stands for, words of the hash by which a sentence is found, and sentences from which a rule may miss one.
SLOT, KEY, NEAR = 16, 3, 4
STEMS = ("licen", "permission", "redistribut", "warrant", "software", "copyright")
_VERSION = re.compile(r"v?(\d+(?:\.\d+)*)$")
_INNER_VERSION = re.compile(r"(?<![0-9a-z.])v?(\d+(?:\.\d+)*)(?![0-9a-z])")
_WORD = re.compile(r"\S+")
_ENDS = ".!?;"
_PUNCTUATION = "\"'`.,;:!?()[]{}<>*#/|=~_-•·"
#: A list number or letter, which counts only as the first word of a line.
_LISTED = re.compile(r"\(?(?:\d{1,2}|[a-z]|[ivx]{1,4})[.)]$")


@dataclass
class Words:
    """Normalised words of a text, the version taken out of each, and the places where they stand."""

    forms: list[str]
    versions: list[str]
    places: list[tuple[int, int]]
    #: Whether a piece of the text begins at the word, and ends with it.
    begins: list[bool]
    ends: list[bool]


def folded(text: str) -> str:
    return text.lower() if text.isascii() else unicodedata.normalize("NFKC", text).lower()


def word_form(word: str) -> tuple[str, str]:
    """The word without punctuation around it, and a version taken out of it; a word of punctuation alone is empty."""
    text = folded(word).strip(_PUNCTUATION).replace('"', "")
    whole = _VERSION.match(text)
    if whole:
        return "{v}", whole[1]
    inner = _INNER_VERSION.search(text)
    return (text[: inner.start()] + "{v}" + text[inner.end() :], inner[1]) if inner and not text.startswith("spdx") else (text, "")


def words_of(text: str) -> Words:
    """Words of a text. Comment marks and list numbers before a line are none."""
    out = Words([], [], [], [], [])
    before, broken = 0, True
    for m in _WORD.finditer(text):
        word = m.group()
        new_line = not out.forms or "\n" in text[before : m.start()] or "\r" in text[before : m.start()]
        broken = broken or new_line
        form, version = word_form(word)
        if not form or (broken and _LISTED.match(folded(word))):
            continue
        if out.forms and broken:
            out.ends[-1] = True
        out.forms.append(form)
        out.versions.append(version)
        out.places.append((m.start(), m.end()))
        out.begins.append(broken)
        out.ends.append(False)
        broken, before = folded(word).rstrip("\"')]")[-1:] in _ENDS and bool(word), m.end()
    if out.forms:
        out.ends[-1] = True
    return out


class Table:
    """Known sentences by the hash of their first KEY words; those that begin with a slot by the words behind it."""

    def __init__(self, sentences: dict[str, tuple[str, ...]]):
        self.by_first: dict[tuple[str, ...], list[tuple[str, list[str]]]] = {}
        self.by_second: dict[tuple[str, ...], list[tuple[str, list[str]]]] = {}
        self.short: dict[str, list[tuple[str, list[str]]]] = {}
        hints = set()
        for name, forms in sentences.items():
            for form in dict.fromkeys(forms):
                parts = [p if p in ("{*}", "{id}") else word_form(p.replace("{v}", "2.0"))[0] for p in form.split(" ")]
                hints.add(next((s for s in STEMS if s in form), max(re.findall(r"[a-z0-9-]+", form), key=len)))
                if parts[0] == "{*}":
                    self.by_second.setdefault(tuple(parts[1 : 1 + KEY]), []).append((name, parts))
                elif len(parts) < KEY or "{*}" in parts[:KEY] or "{id}" in parts[:KEY]:
                    self.short.setdefault(parts[0], []).append((name, parts))
                else:
                    self.by_first.setdefault(tuple(parts[:KEY]), []).append((name, parts))
        self.hint = re.compile("|".join(map(re.escape, sorted(hints))))

    def at(self, words: Words, n: int) -> tuple[str, str, int] | None:
        """Identifier, version and end (a word's number) of the longest known sentence that begins at word n."""
        forms, best = words.forms, None
        able = [*self.by_first.get(tuple(forms[n : n + KEY]), ()), *self.short.get(forms[n], ())]
        for behind in range(n + 1, min(n + SLOT + 1, len(forms))):
            if words.begins[behind]:  # what a leading slot stands for lies in one piece
                break
            able += self.by_second.get(tuple(forms[behind : behind + KEY]), ())
        for name, parts in able:
            end, version = matched(words, n, parts)
            if end is not None and words.ends[end - 1] and (best is None or end > best[2]):
                best = (name, version, end)
        return best


def matched(words: Words, n: int, parts: list[str]) -> tuple[int | None, str]:
    """Where a sentence that begins at word n ends, if it does, and its first version (or identifier).

    A slot ends where the words behind it first stand.
    """
    at, version, k = n, "", 0
    while k < len(parts):
        if parts[k] == "{*}":
            rest = parts[k + 1 : k + 1 + KEY]
            rest = rest[: rest.index("{*}")] if "{*}" in rest else rest
            if not rest:  # a slot at the end takes the rest of the piece
                at += 1
                while at < len(words.forms) and at - n < 10_000 and not words.ends[at - 1]:
                    at += 1
                return (at if at <= len(words.forms) else None), version
            found = next((p for p in range(at + 1, min(at + SLOT, len(words.forms)) + 1) if words.forms[p : p + len(rest)] == rest), None)
            if found is None:
                return None, ""
            at = found
        else:
            if at >= len(words.forms) or (parts[k] != "{id}" and words.forms[at] != parts[k]):
                return None, ""
            if parts[k] == "{id}":
                version = ""
            elif words.versions[at] and not version:
                version = words.versions[at]
            at += 1
        k += 1
    return at, version


def table_of(sentences: dict[str, tuple[str, ...]]) -> Table:
    return Table(sentences)


def sentence_run(words: Words, table: Table) -> list[tuple[str, str, int, int]]:
    """Identifier, version, first word and end of the known sentences, left to right without overlap."""
    met, n = [], 0
    while n < len(words.forms):
        hit = table.at(words, n) if words.begins[n] else None
        if hit:
            met.append((hit[0], hit[1], n, hit[2]))
            n = hit[2]
        else:
            n += 1
    return met


def rule_match(met: list[tuple], k: int, rule: Rule) -> tuple[int, int] | None:
    """Sentences taken and missed by a rule that begins with the k-th sentence met: all in order, or of a long rule all but one."""
    taken = missed = 0
    for place, wanted in enumerate(rule.sentences):
        here = met[k + taken] if k + taken < len(met) else None
        follows = here is not None and (taken == 0 or here[2] == met[k + taken - 1][3])
        if here is not None and here[0] == wanted and (follows or len(rule.sentences) >= NEAR):
            taken += 1
        elif len(rule.sentences) >= NEAR and 0 < place and missed == 0:
            missed += 1
        else:
            return None
    return taken, missed


def recognised(text: str, table: Table, rules: tuple[Rule, ...]) -> list[tuple[str, str, int, int, int]]:
    """License, version, start and end (code points) of each rule match and how many of its sentences are missing.

    Left to right, most sentences first, without overlap. Sentences of one rule follow one another; in a rule of NEAR
    sentences or more other words may stand between them, and one of them may be missing.
    """
    if not table.hint.search(folded(text)):
        return []
    words = words_of(text)
    met = sentence_run(words, table)
    found, k = [], 0
    while k < len(met):
        best = None
        for rule in rules:
            fits = rule_match(met, k, rule) if rule.sentences[0] == met[k][0] else None
            if fits and (best is None or (fits[0], -fits[1]) > (best[1][0], -best[1][1])):
                best = (rule, fits)
        if best is None:
            k += 1
            continue
        rule, (taken, missed) = best
        run = met[k : k + taken]
        start, end = words.places[run[0][2]][0], words.places[run[-1][3] - 1][1]
        if rule.license == "spdx":
            a, b = words.places[run[0][3] - 1]
            found.append((folded(text[a:b]).strip("\"'()[]{}<>*#,;"), "", start, end, missed))
        else:
            found.append((rule.license, next((x[1] for x in run if x[1]), ""), start, end, missed))
        k += taken
    return found


def license_scan(docs: DataFrame, key: str = "doc_id", text: str = "text", sentences: dict[str, tuple[str, ...]] | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, license, version, start, end, missing: one row for each licence notice in each whole text (code points, end exclusive).

    Null and empty texts hold none; repeated rows each give their rows; of rules that match alike the first counts; extra
    columns are ignored, and an empty table gives no row. Texts that hold no stem of any known sentence, folded as the
    sentences are, are passed over.
    """
    table = table_of(sentences or SENTENCES)
    source = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")).filter("text is not null")
    schema = f"doc_id {source.schema['doc_id'].dataType.simpleString()}, license string, version string, start long, end long, missing long"

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(n, *hit) for n, t in enumerate(batch.column(1).to_pylist()) for hit in recognised(t, table, rules)]
            taken = batch.column(0).take(pa.array([r[0] for r in rows], pa.int64()))
            kinds = (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([taken, *(pa.array([r[k + 1] for r in rows], kind) for k, kind in enumerate(kinds))], names=["doc_id", "license", "version", "start", "end", "missing"])

    return source.mapInArrow(scan, schema)
