"""Licence sentences, ordered rules and odd rows."""

from reelrank.llm import licenses as lic


def test_rules_order_and_odd_rows(spark):
    s = lic.SENTENCES
    mit = "\n".join(s[k].capitalize() + "." for k in "hij")
    bsd3 = ". ".join(s[k] for k in "klmn") + "."
    rows = [(1, "Some text. Released under the MIT License. More text!"),
            (2, "Head\n" + mit + "\nReleased under the MIT license."),
            (3, bsd3.upper()), (4, bsd3.replace(s["n"] + ".", "")),
            (5, "Licensed under the Apache License, Version 2.0.\nLicensed under CC BY-NC 4.0."),
            (6, s["h"] + ". Something else. " + s["i"]), (7, None), (8, ""), (9, "No such thing here"),
            (1, "Some text. Released under the MIT License. More text!"), (None, "All rights reserved"),
            (10, "é. " * 30_000 + "(Licensed under CC BY 4.0.)")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, sequence string")
    out = lic.scan(df).collect()
    assert len(out) == len(rows)
    by = {r["doc_id"]: r for r in out}
    assert {k: r["licence"] for k, r in by.items()} == {
        1: "MIT", 2: "MIT", 3: "BSD-3-Clause", 4: "BSD-2-Clause", 5: "Apache-2.0",
        6: "MIT-permission", 7: None, 8: None, 9: None, 10: "CC-BY-4.0", None: "All-rights-reserved"}
    assert by[1]["sequence"] == "-a-" and (by[1]["n_sentences"], by[1]["n_known"]) == (3, 1)
    assert by[2]["licences"] == "MIT,MIT-permission"
    assert by[3]["licences"] == "BSD-3-Clause,BSD-2-Clause,BSD-conditions"
    assert by[5]["licences"] == "Apache-2.0,CC-BY-NC-4.0"
    assert by[7]["n_sentences"] == 0 and by[7]["licences"] == "" and by[7]["sequence"] == ""
    assert by[10]["n_sentences"] == 30_001
    assert lic.scan(df.limit(0)).count() == 0


def test_plan_is_native_and_has_no_shuffle(spark):
    plan = lic.op5_license_scan(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_known_sentences_pass_the_quick_filter():
    import re
    assert all(re.search("licen|permi|copyright|warrant|redistribut|rights reserved", x)
               for x in lic.SENTENCES.values())
    assert all(len(k) == 1 for k in lic.SENTENCES) and {c for _, r in lic.RULES for c in r} <= set(lic.SENTENCES)


APACHE = """Copyright 2020 Someone

Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS.
"""
GPL = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.
"""
MIT = """MIT License

Copyright (c) 2020 Someone

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
"""
BSD2 = """Copyright (c) 2020, Someone
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
BSD3 = BSD2 + """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""


def gnu(thing, name, upto):
    return f"""This {thing} is free software{':' if '3' in upto else ';'} you can redistribute it and/or
modify it under the terms of the GNU {name} as published by
the Free Software Foundation{upto}.
"""


LATER = ", or\n(at your option) any later version"
ISC = """Copyright (c) 2020 Someone

Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.
"""
MORE = {
    "GPL-2.0-or-later": gnu("program", "General Public License", "; either version 2\nof the License" + LATER),
    "GPL-2.0-only": gnu("program", "General Public License version 2", ""),
    "LGPL-2.1-or-later": gnu("library", "Lesser General Public\nLicense", "; either\nversion 2.1 of the License" + LATER),
    "LGPL-3.0-or-later": gnu("program", "Lesser General Public License", ", either version 3 of the License" + LATER),
    "AGPL-3.0-or-later": gnu("program", "Affero General Public License", ", either version 3 of the\nLicense" + LATER),
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at http://mozilla.org/MPL/2.0/.
""",
    "ISC": ISC,
    "0BSD": ISC[:ISC.index(", provided")] + ".\n",
    "BSL-1.0": """Permission is hereby granted, free of charge, to any person or organization
obtaining a copy of the software and accompanying documentation covered by
this license (the "Software") to use, reproduce, display, distribute,
execute, and transmit the Software, and to prepare derivative works of the
Software, and to permit third-parties to whom the Software is furnished to
do so, all subject to the following:
""",
}


def test_spdx_tags(spark):
    rows = [(1, "// SPDX-License-Identifier: MIT\ncode"), (2, "/* SPDX-License-Identifier:\tGPL-2.0-only */ x"),
            (3, "# SPDX-License-Identifier: (MIT OR Apache-2.0) AND BSD-3-Clause\n# SPDX-License-Identifier: 0BSD\n"
                "<!-- SPDX-License-Identifier: 0BSD -->"),
            (4, "SPDX-License-Identifier:"), (5, "SPDX-License-Identifier"), (6, None), (7, "")]
    got = dict(lic.scan(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "declared").collect())
    assert got == {1: "MIT", 2: "GPL-2.0-only", 3: "(MIT OR Apache-2.0) AND BSD-3-Clause,0BSD", 4: "", 5: "", 6: "", 7: ""}


def test_sql_twin_on_one_line_licences(spark, tmp_path):
    import duckdb
    texts = [*(s.capitalize() + "." for s in lic.SENTENCES.values()), None, "", "no licence",
             "x // SPDX-License-Identifier: MIT OR ISC\n# SPDX-License-Identifier: ISC", *(
                 " ".join(t.split()) for t in MORE.values())]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    df.coalesce(1).write.parquet(str(tmp_path / "d"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/d/*.parquet'")
    got = {tuple(r) for r in lic.scan(df).collect()}
    assert got == set(con.execute(lic.SQL).fetchall()) and len(got) == len(texts)


def test_licences_as_they_are_wrapped(spark):
    texts = {**MORE, "Apache-2.0": APACHE, "GPL-3.0-or-later": GPL, "MIT": MIT, "BSD-2-Clause": BSD2, "BSD-3-Clause": BSD3}
    rows = []
    for name, text in texts.items():
        for lead in ("", "# ", " * ", "// "):
            rows.append((name, "".join(f"{lead}{x}".rstrip() + "\n" for x in text.splitlines())))
        rows.append((name, text.replace("\n", "\r\n")))
    df = spark.createDataFrame(rows, "doc_id string, text string")
    got = [(r["doc_id"], r["licence"]) for r in lic.scan(df).collect()]
    assert len(got) == 5 * len(texts) and [x for x in got if x[0] != x[1]] == []
