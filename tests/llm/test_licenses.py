import pytest
from pyspark.sql import functions as F

from ledgerline.llm import licenses as L

MIT = """# MIT License
#
# Copyright (c) 2020 Someone
#
# Permission is hereby granted, free of charge, to any person obtaining a copy
# of this software and associated documentation files (the "Software"), to deal
# in the Software without restriction, including without limitation the rights
# to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
# copies of the Software, and to permit persons to whom the Software is
# furnished to do so, subject to the following conditions:
#
# The above copyright notice and this permission notice shall be included in all
# copies or substantial portions of the Software.
#
# THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
# IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
# FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
# AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
# LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
# OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
# SOFTWARE.
"""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

   http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.
"""
CASES = [
    (1, MIT, "MIT", 4, 1, 0),
    (2, "text before\n" + APACHE + "text after", "Apache-2.0", 5, 1, 0),
    (3, "Some words\nLicensed under CC BY-NC 4.0.\nmore", "CC-BY-NC-4.0", 1, 1, 0),
    (4, "Released under the MIT License. // released UNDER the mit license", "MIT", 2, 2, 0),
    (5, MIT + "\n" + "Licensed under the Apache License, Version 2.0.", "MIT,Apache-2.0", 5, 2, 0),
    (6, "See the License for the specific language governing permissions and limitations under the License.", "", 1, 0, 1),
    (7, "// SPDX-License-Identifier: GPL-3.0-only\nint x;", "GPL-3.0-only", 1, 1, 0),
    (8, "no notice, but a license and a copyright are named", "", 0, 0, 0),
    (9, None, "", 0, 0, 0), (10, "", "", 0, 0, 0), (None, "Licensed under CC BY 4.0", "CC-BY-4.0", 1, 1, 0),
    (11, "words " * 20000 + "\nThis work is licensed under the GNU General Public License, version 3.", "GPL-3.0-only", 1, 1, 0),
]


def test_cases(spark):
    df = spark.createDataFrame([c[:2] for c in CASES] * 2, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("id", "r", "left")})
    got = sorted((str(r.id), r.licenses, r.n_sentences, r.n_matches, r.n_unmatched) for r in L.scan(df).collect())
    assert got == sorted((str(c[0]), *c[2:]) for c in CASES * 2)
    assert L.scan(df.limit(0)).count() == 0


def test_every_known_sentence_has_an_anchor_and_a_rule_of_known_ids():
    import re
    assert all(re.search(L.ANCHOR, s) for forms in L.SENTENCES.values() for s in forms)
    assert {x for _, run in L.RULES for x in run} <= set(L.SENTENCES)


def test_further_notices_and_own_tables(spark):
    rows = [(1, "Licensed under the Mozilla Public License, version 2.0."), (2, "x\nSPDX-License-Identifier: ISC\ny"), (3, "See: CC BY-SA 4.0"),
            (4, "Our House License applies.")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.id: r.licenses for r in L.scan(df).collect()} == {1: "MPL-2.0", 2: "ISC", 3: "CC-BY-SA-4.0", 4: ""}
    own = L.scan(df, sentences={"House": ("Our House License applies",)}, rules=(("House", ("House",)),))
    assert {r.id: r.licenses for r in own.collect()} == {1: "", 2: "", 3: "", 4: "House"}
    with pytest.raises(ValueError):
        L.scan(df, sentences={"A": ("nothing that is looked for",)})
