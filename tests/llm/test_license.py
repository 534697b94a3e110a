from closewright.llm import license as L

NOTICE = """// The MIT License (MIT)
//
// Some words of no licence.
Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.
You may obtain a copy of the License at
    http://www.apache.org/licenses/LICENSE-2.0
SPDX-License-Identifier: BSD-3-Clause
* Released under the MIT License. This work is licensed under the GNU General Public License, version 3.
Licensed   under CC BY-NC 4.0."""
CLEAN = "Licensed practitioners released the bird. Permission was not asked for. The license of poets."


def test_rules_over_lines_and_versions(spark):
    docs = spark.createDataFrame([(1, NOTICE, 1), (2, CLEAN, 1), (3, None, 1), (None, "MIT License", 1), (4, "", 1), (1, "MIT License", 1), (5, "Word. " * 50000 + "MIT License.", 1)], "doc_id long, text string, start int")
    got = sorted(((r.doc_id or -1, r.start, r.license, r.version, r.end) for r in L.license_scan(docs).collect()))
    here = [g for g in got if g[0] == 1 and g[4] > 11]
    assert [(g[2], g[3]) for g in here] == [("mit", ""), ("apache", "2.0"), ("bsd-3-clause", ""), ("mit", ""), ("gpl", "3"), ("cc-by-nc", "4.0")]
    assert NOTICE[here[1][1] : here[1][4]].startswith("Licensed under the Apache") and NOTICE[: here[1][4]].endswith("LICENSE-2.0")
    assert [g for g in got if g[0] not in (1,)] == [(-1, 0, "mit", "", 11), (5, 300000, "mit", "", 300012)]
    assert (1, 0, "mit", "", 11) in got
    assert L.license_scan(docs.limit(0)).count() == 0


def test_ordered_rules_take_the_longest(spark):
    sentences = {"a": ("alpha licence",), "b": ("beta licence {v}",)}
    rules = (L.Rule("one", ("a",)), L.Rule("two", ("a", "b")), L.Rule("three", ("b",)))
    known = L.table_of(sentences)
    found = lambda t: [x[:2] for x in L.recognised(t, known, rules)]
    assert found("Alpha licence.\nBeta licence 2.1\nbeta licence 3; alpha licence") == [("two", "2.1"), ("three", "3"), ("one", "")]
    assert found("alpha licence. other. beta licence 1") == [("one", ""), ("three", "1")]


APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."""
MIT = """Permission
is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software."""
GPL = """This program is free software; you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation; either version 2 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions
are met:"""
ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies."""


def test_whole_commented_headers():
    known = L.table_of(L.SENTENCES)
    for mark in ("", "# ", "// ", " * ", ";; ", "-- "):
        for name, version, notice in (("apache", "2.0", APACHE), ("mit", "", MIT), ("gpl", "2", GPL), ("bsd", "", BSD), ("isc", "", ISC)):
            lines = "\n".join((mark + line).rstrip() for line in notice.split("\n"))
            text = f"{mark}Copyright 2020 someone\n{mark.rstrip()}\n{lines}\n{mark.rstrip()}\nx = 1\n"
            got = L.recognised(text, known, L.RULES)
            assert [g[:2] for g in got] == [(name, version)], (mark, name, got)
            assert text[got[0][2] : got[0][3]].strip("#/*;- ") == lines.strip("#/*;- ")
    assert [g[:2] for g in L.recognised('# Licensed under the Apache License, Version 2.0 (the "License");\n# other words', known, L.RULES)] == [("apache", "2.0")]


def found(text):
    return [g[:2] for g in L.recognised(text, L.table_of(L.SENTENCES), L.RULES)]


def test_marks_indentation_and_width_do_not_hide_a_notice():
    assert found("/" + "*" * 100 + "\nReleased under the MIT License.\n") == [("mit", "")]
    assert found(" " * 120 + "Licensed under the Apache License, Version 2.0") == [("apache", "2.0")]
    narrow = "\n".join("            * " + w for w in MIT.split())
    assert found(narrow) == [("mit", "")] and len(narrow) > 1180
    assert found("\uff2d\uff29\uff34 \uff2c\uff49\uff43\uff45\uff4e\uff53\uff45") == [("mit", "")]


LGPL = """This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version 2.1 of the License, or (at your option) any later version."""
AGPL = """    This program is free software: you can redistribute it and/or modify
    it under the terms of the GNU Affero General Public License as
    published by the Free Software Foundation, either version 3 of the
    License, or (at your option) any later version."""
BSD3 = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED."""


def test_notices_as_printed():
    assert found(LGPL) == [("lgpl", "2.1")] and found(AGPL) == [("agpl", "3")]
    assert found("This is free and unencumbered software released into the public domain.") == [("unlicense", "")]
    assert found("Creative Commons Attribution 4.0 International") == [("cc-by", "4.0")]
    assert found("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.") == [("cc-by-sa", "4.0")]
    assert found("# SPDX-License-Identifier: Apache-2.0\n") == [("apache-2.0", "")]


def test_clauses_tell_bsd_apart():
    parts = BSD3.split("\n\n")
    assert found(BSD3) == [("bsd-3-clause", "")]
    assert found("\n\n".join(parts[:3] + parts[4:])) == [("bsd-2-clause", "")]
    advertising = "3. All advertising materials mentioning features or use of this software must\ndisplay the following acknowledgement: This product includes software developed by the someone."
    assert found("\n\n".join(parts[:3] + [advertising] + parts[3:])) == [("bsd-4-clause", "")]
    bulleted = BSD3.replace("1. ", "* ").replace("2. ", "* ").replace("3. ", "* ")
    assert found("\n".join(" * " + line for line in bulleted.split("\n"))) == [("bsd-3-clause", "")]


def test_a_long_rule_may_miss_one_sentence():
    whole = L.recognised(BSD3, L.table_of(L.SENTENCES), L.RULES)
    cut = BSD3.replace("provided with the distribution", "given away")
    near = L.recognised(cut, L.table_of(L.SENTENCES), L.RULES)
    assert whole[0][4] == 0 and near[0][0] == "bsd-3-clause" and near[0][4] == 1
    assert (near[0][2], near[0][3]) == (whole[0][2], whole[0][3] - len(BSD3) + len(cut))


def test_many_licences_are_known():
    assert len({r.license for r in L.RULES}) >= 40
    used = {s for r in L.RULES for s in r.sentences}
    assert used == set(L.SENTENCES)
    table = L.table_of(L.SENTENCES)
    for name, forms in L.SENTENCES.items():
        for form in forms:
            spelled = form.replace("{v}", "2.0").replace("{*}", "some one").replace("{id}", "X-1")
            words = L.words_of(spelled)
            hit = table.at(words, 0)
            assert hit and hit[2] == len(words.forms), (name, form, words.forms, hit)


def test_sentences_against_brute_force():
    """Every known sentence without a slot at every piece, by comparing words."""
    import random

    r, forms = random.Random(6), {form: name for name, held in L.SENTENCES.items() for form in held if "{" not in form}
    table = L.table_of({name: tuple(f for f in held if "{" not in f) for name, held in L.SENTENCES.items() if any("{" not in f for f in held)})
    for _ in range(60):
        text = ""
        for _ in range(12):
            words = r.choice(list(forms)).split() if r.random() < 0.5 else ["the", "license", "bird"][: r.randint(1, 3)]
            if r.random() < 0.3:
                words[r.randrange(len(words))] = "changed"
            text += "".join(w + r.choice([" ", " ", "\n", "\n# ", "  "]) for w in words[:-1]) + words[-1] + r.choice([". ", "\n", "; ", " "])
        words = L.words_of(text)
        plain, n = [], 0
        while n < len(words.forms):
            ends = [len(f.split()) for f in forms if words.begins[n] and words.forms[n : n + len(f.split())] == f.split() and words.ends[n + len(f.split()) - 1]]
            if ends:
                plain.append((forms[" ".join(words.forms[n : n + max(ends)])], n, n + max(ends)))
            n += max(ends, default=1)
        assert [(x[0], x[2], x[3]) for x in L.sentence_run(words, table)] == plain
