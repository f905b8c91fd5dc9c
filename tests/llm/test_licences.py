from ledgerlens.llm import licence_texts as T
from ledgerlens.llm import licences as L

FILES = [
    (1, "a/LICENSE", "Licensed under the Apache License, Version 2.0."),
    (2, "a/b/c/x.txt", "Some text of ours.\nand more of it"),
    (3, "a/b/COPYING.txt", "Released under the MIT License.\n\nAll of it."),
    (4, "a/b/c/y.txt", "# SPDX-License-Identifier: GPL-3.0\ncode"),
    (5, "d/z.txt", "nothing here"),
    (6, None, "All rights reserved."),
    (7, "a/q.txt", None),
    (8, "a/q.txt", ""),
    (8, "a/q.txt", ""),
    (9, "ab/r.txt", "no license above, though the name starts alike"),
    (10, "top.txt", "word " * 50_000),
]


def test_scan(spark):
    # Many plain files make the words of the notices rare.
    plain = [(100 + i, f"p/{i}.txt", f"the work is of version {i} in all the rooms under one roof") for i in range(60)]
    rows = spark.createDataFrame(FILES + plain, "doc_id long, path string, text string").selectExpr("*", "'x' as license", "1 as score", "'y' as dir")
    got = {r["file_id"]: r for r in L.scan(rows).collect()}
    assert got[1]["declared"] == "Apache-2.0" and got[3]["declared"] == "MIT" and got[4]["declared"] == "GPL-3.0"
    assert (got[2]["license"], got[2]["inherited_from"]) == ("MIT", "a/b") and got[2]["declared"] is None
    assert got[4]["license"] == "GPL-3.0" and got[4]["inherited"] == "MIT"
    assert got[7]["license"] == got[8]["license"] == "Apache-2.0"
    assert got[5]["license"] is None and got[9]["license"] is None and got[10]["license"] is None
    assert got[6]["license"] == "proprietary"
    assert L.scan(rows).count() == rows.count() and L.scan(rows.limit(0)).count() == 0


NEAR_MISSES = [
    ("Licensed under the Apache License, Version 2.0.", "Apache-2.0"),
    ("Copyright 2024 Acme. Licensed under the Apache License, Version 2.0.", "Apache-2.0"),
    ("# Licensed under the Apache License, Version 2.0 (the \"License\");\n# you may not use this file except in compliance with the License.", "Apache-2.0"),
    ("Licensed under the Apache License, Version 1.1.", None),
    ("This work is licensed under the GNU General Public License, version 2.", "GPL-2.0"),
    ("This work is licensed under the GNU General Public License, version 3.", "GPL-3.0"),
    ("This work is licensed under the GNU Lesser General Public License, version 3.", "LGPL-3.0"),
    ("This work is licensed under the GNU Lesser General Public License, version 2.1.", "LGPL-2.1"),
    ("This work is licensed under the GNU Affero General Public License, version 3.", "AGPL-3.0"),
    ("// SPDX-License-Identifier: MPL-2.0", "MPL-2.0"),
    ("SPDX-License-Identifier: BSD-2-Clause", "BSD-2-Clause"),
    ("SPDX-License-Identifier: BSD-3-Clause", "BSD-3-Clause"),
    ("SPDX-License-Identifier: Zlib", None),
    ("SPDX-License-Identifier: EUPL-1.2", None),
    ("Licensed under CC BY 4.0.", "CC-BY-4.0"),
    ("Licensed under CC BY-SA 4.0.", "CC-BY-SA-4.0"),
    ("Licensed under CC BY-NC 4.0.", "CC-BY-NC-4.0"),
    ("Licensed under CC BY-NC-SA 4.0.", "CC-BY-NC-SA-4.0"),
    ("Licensed under CC BY-ND 4.0.", "CC-BY-ND-4.0"),
    ("Released under the ISC License.", "ISC"),
    ("# Copyright (c) 2024 Jane Roe. Released under the MIT License.", "MIT"),
    ("Released under the Zlib License.", None),
    ("Copyright 2024 Acme Corp. All rights reserved.", "proprietary"),
    ("Copyright 2020 A. Roe.\nAll rights reserved.\n\n" + T.BSD_HEAD + "\n\n" + T.BSD_TAIL, "BSD-2-Clause"),
    ("Copyright 2020 A. Roe.\nAll rights reserved.\n\n" + T.BSD_HEAD + "\n" + T.BSD_ENDORSE + "\n" + T.BSD_TAIL, "BSD-3-Clause"),
    ("MIT License\n\nCopyright (c) 2024 Jane Roe\n\n" + T.MIT_TEXT, "MIT"),
    ("ISC License\n\nCopyright (c) 2024 Jane Roe\n\n" + T.ISC_TEXT, "ISC"),
    ("GNU GENERAL PUBLIC LICENSE\n   Version 2, June 1991\n\nEveryone is permitted to copy", "GPL-2.0"),
    ("GNU GENERAL PUBLIC LICENSE\n   Version 3, 29 June 2007\n\nEveryone is permitted to copy", "GPL-3.0"),
    ("GNU LESSER GENERAL PUBLIC LICENSE\n   Version 3, 29 June 2007\n", "LGPL-3.0"),
    ("The people of the town released a cat.\nIt is in the house.", None),
]


def test_near_misses(spark):
    """Each version and variant is told apart from its like; what isn't listed stays unknown."""
    files = [(i, f"n{i}/LICENSE", t) for i, (t, _) in enumerate(NEAR_MISSES)]
    plain = [(1000 + i, f"p/{i}.txt", f"the work is of version {i} in all the rooms under one roof of the house") for i in range(300)]
    got = {r["file_id"]: r["declared"] for r in L.scan(spark.createDataFrame(files + plain, "doc_id long, path string, text string")).collect()}
    wrong = {t[:60]: (got[i], want) for i, (t, want) in enumerate(NEAR_MISSES) if got[i] != want}
    assert not wrong


def test_key_tokens_lose_nothing():
    """No text without a key token of a template reaches the threshold."""
    v = L.weigh(1000, {"the": 900, "of": 800, "and": 700, "in": 600, "is": 500, "this": 400, "all": 300, "to": 650, "under": 50})
    for _, norm, weights in v.templates:
        rest = sum(x * x for w, x in weights.items() if w not in v.keys) ** 0.5
        assert rest < L.Params().threshold * norm
