"""Licence recognition by sentences and ordered rules, in DataFrame operations only.

A text is cut into fragments at line ends and sentence ends; runs of fragments, as long as any known
licence sentence can reach, are normalised and looked up among the known sentences. The identifiers found, in the order of
the text, are matched against ordered rules; a rule that matches consumes its identifiers.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewright.llm.shared import ascii_lower, row_key

BREAKS = r"[.!?;:]+[\x20\x09-\x0D]+|\n+"

# Sentences of public licence notices, and the identifier of each.
SENTENCES = [
    ("ApacheV2", "Licensed under the Apache License, Version 2.0"),
    ("ApacheV2", "This project is licensed under the Apache License, Version 2.0"),
    ("ApacheV2", "Licensed under the Apache License, Version 2.0 (the \"License\")"),
    ("ApacheComply", "you may not use this file except in compliance with the License"),
    ("ApacheCopy", "You may obtain a copy of the License at"),
    ("ApacheDist", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied"),
    ("ApacheSee", "See the License for the specific language governing permissions and limitations under the License"),
    ("MITRef", "Released under the MIT License"),
    ("MITRef", "Licensed under the MIT License"),
    ("MITRef", "This project is licensed under the MIT License"),
    ("MITPerm", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions"),
    ("MITNotice", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software"),
    ("MITAsIs", "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT"),
    ("MITLiab", "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE"),
    ("GPLv3Ref", "This work is licensed under the GNU General Public License, version 3"),
    ("GPLv3Ref", "Licensed under the GNU General Public License, version 3"),
    ("GPLv3Ref", "Licensed under the GNU GPL version 3"),
    ("GPLv2Ref", "Licensed under the GNU General Public License, version 2"),
    ("GPLv2Ref", "This work is licensed under the GNU General Public License, version 2"),
    ("LGPLv3Ref", "Licensed under the GNU Lesser General Public License, version 3"),
    ("AGPLv3Ref", "Licensed under the GNU Affero General Public License, version 3"),
    ("GPLFree", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("GPLFree2", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version"),
    ("GPLHope", "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE"),
    ("GPLSee", "See the GNU General Public License for more details"),
    ("GPLCopy", "You should have received a copy of the GNU General Public License along with this program"),
    ("BSDPerm", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSDSource", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer"),
    ("BSDBinary", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution"),
    ("BSDEndorse", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("BSDRef", "Licensed under the BSD License"),
    ("BSD3Ref", "Licensed under the 3-clause BSD License"),
    ("BSD2Ref", "Licensed under the 2-clause BSD License"),
    ("ISCPerm", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("MPL2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("MPL2", "Licensed under the Mozilla Public License, version 2.0"),
    ("CCBY4", "Licensed under CC BY 4.0"),
    ("CCBY4", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("CCBYSA4", "Licensed under CC BY-SA 4.0"),
    ("CCBYSA4", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("CCBYNC4", "Licensed under CC BY-NC 4.0"),
    ("CCBYNC4", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("CCBYND4", "Licensed under CC BY-ND 4.0"),
    ("CCBYNCSA4", "Licensed under CC BY-NC-SA 4.0"),
    ("CC0", "Licensed under CC0 1.0"),
    ("CC0", "To the extent possible under law, the author has waived all copyright and related rights to this work"),
    ("PublicDomain", "This work is in the public domain"),
    ("Unlicense", "This is free and unencumbered software released into the public domain"),
    ("BSDAsIs", "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED"),
    ("BSDLiab", "IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE"),
    ("ISCAsIs", "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS"),
    ("ISCLiab", "IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE"),
    ("ZeroBSDPerm", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("ZlibAsIs", "This software is provided 'as-is', without any express or implied warranty"),
    ("ZlibLiab", "In no event will the authors be held liable for any damages arising from the use of this software"),
    ("ZlibPerm", "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions"),
    ("BoostPerm", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following"),
    ("BoostRef", "Distributed under the Boost Software License, Version 1.0"),
    ("LGPLFree2", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version"),
    ("LGPLFree3", "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("LGPLHope", "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE"),
    ("LGPLSee", "See the GNU Lesser General Public License for more details"),
    ("LGPLCopy", "You should have received a copy of the GNU Lesser General Public License along with this library"),
    ("AGPLFree", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("AGPLSee", "See the GNU Affero General Public License for more details"),
    ("AGPLCopy", "You should have received a copy of the GNU Affero General Public License along with this program"),
    ("FSFVerbatim", "Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed"),
    ("GPLv3Text", "The GNU General Public License is a free, copyleft license for software and other kinds of works"),
    ("GPLv2Text", "The licenses for most software are designed to take away your freedom to share and change it"),
    ("AGPLv3Text", "The GNU Affero General Public License is a free, copyleft license for software and other kinds of works, specifically designed to ensure cooperation with the community in the case of network server software"),
    ("LGPLv3Text", "This version of the GNU Lesser General Public License incorporates the terms and conditions of version 3 of the GNU General Public License, supplemented by the additional permissions listed below"),
    ("ApacheGrant", "Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license to reproduce, prepare Derivative Works of, publicly display, publicly perform, sublicense, and distribute the Work and such Derivative Works in Source or Object form"),
    ("MPLCopy", "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/"),
    ("MPLCopy", "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/"),
    ("MPLGrant", "Each Contributor hereby grants You a world-wide, royalty-free, non-exclusive license"),
    ("EPL2", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at"),
    ("UnlicenseFree", "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means"),
    ("CCBY4Text", "By exercising the Licensed Rights (defined below), You accept and agree to be bound by the terms and conditions of this Creative Commons Attribution 4.0 International Public License (\"Public License\")"),
    ("CCBYSA4Text", "By exercising the Licensed Rights (defined below), You accept and agree to be bound by the terms and conditions of this Creative Commons Attribution-ShareAlike 4.0 International Public License (\"Public License\")"),
    ("CCBYNC4Text", "By exercising the Licensed Rights (defined below), You accept and agree to be bound by the terms and conditions of this Creative Commons Attribution-NonCommercial 4.0 International Public License (\"Public License\")"),
    ("CCBYND4Text", "By exercising the Licensed Rights (defined below), You accept and agree to be bound by the terms and conditions of this Creative Commons Attribution-NoDerivatives 4.0 International Public License (\"Public License\")"),
    ("CCBYNCSA4Text", "By exercising the Licensed Rights (defined below), You accept and agree to be bound by the terms and conditions of this Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International Public License (\"Public License\")"),
    ("CC0Text", "CREATIVE COMMONS CORPORATION IS NOT A LAW FIRM AND DOES NOT PROVIDE LEGAL SERVICES"),
    ("Reserved", "All rights reserved"),
]

# Rules in the order in which they are tried; (licence, identifiers one after the other).
RULES = [
    ("Apache-2.0", ["ApacheV2", "ApacheComply", "ApacheCopy", "ApacheDist", "ApacheSee"]),
    ("MIT", ["MITPerm", "MITNotice", "MITAsIs", "MITLiab"]),
    ("GPL-3.0-or-later", ["GPLFree", "GPLHope", "GPLSee", "GPLCopy"]),
    ("GPL-2.0-or-later", ["GPLFree2", "GPLHope", "GPLSee", "GPLCopy"]),
    ("LGPL-2.1-or-later", ["LGPLFree2", "LGPLHope", "LGPLSee", "LGPLCopy"]),
    ("LGPL-3.0-or-later", ["LGPLFree3", "LGPLHope", "LGPLSee", "LGPLCopy"]),
    ("AGPL-3.0-or-later", ["AGPLFree", "GPLHope", "AGPLSee", "AGPLCopy"]),
    ("BSD-3-Clause", ["BSDPerm", "BSDSource", "BSDBinary", "BSDEndorse", "BSDAsIs", "BSDLiab"]),
    ("BSD-2-Clause", ["BSDPerm", "BSDSource", "BSDBinary", "BSDAsIs", "BSDLiab"]),
    ("BSD-3-Clause", ["BSDPerm", "BSDSource", "BSDBinary", "BSDEndorse"]),
    ("BSD-2-Clause", ["BSDPerm", "BSDSource", "BSDBinary"]),
    ("ISC", ["ISCPerm", "ISCAsIs", "ISCLiab"]),
    ("0BSD", ["ZeroBSDPerm", "ISCAsIs", "ISCLiab"]),
    ("Zlib", ["ZlibAsIs", "ZlibLiab", "ZlibPerm"]),
    ("BSL-1.0", ["BoostPerm", "MITAsIs"]),
    ("Unlicense", ["Unlicense", "UnlicenseFree"]),
    ("MPL-2.0", ["MPL2", "MPLCopy"]),
    ("GPL-3.0-only", ["FSFVerbatim", "GPLv3Text"]),
    ("GPL-2.0-only", ["FSFVerbatim", "GPLv2Text"]),
    ("AGPL-3.0-only", ["FSFVerbatim", "AGPLv3Text"]),
    ("LGPL-3.0-only", ["FSFVerbatim", "LGPLv3Text"]),
    ("MIT", ["MITPerm", "MITNotice"]),
    ("GPL-3.0-or-later", ["GPLFree"]),
    ("GPL-2.0-or-later", ["GPLFree2"]),
    ("Apache-2.0", ["ApacheV2", "ApacheComply"]),
    ("Apache-2.0", ["ApacheV2"]),
    ("MIT", ["MITRef"]),
    ("GPL-3.0-only", ["GPLv3Ref"]),
    ("GPL-2.0-only", ["GPLv2Ref"]),
    ("LGPL-3.0-only", ["LGPLv3Ref"]),
    ("AGPL-3.0-only", ["AGPLv3Ref"]),
    ("BSD-3-Clause", ["BSD3Ref"]),
    ("BSD-2-Clause", ["BSD2Ref"]),
    ("BSD", ["BSDRef"]),
    ("ISC", ["ISCPerm"]),
    ("0BSD", ["ZeroBSDPerm"]),
    ("BSL-1.0", ["BoostPerm"]),
    ("BSL-1.0", ["BoostRef"]),
    ("LGPL-2.1-or-later", ["LGPLFree2"]),
    ("LGPL-3.0-or-later", ["LGPLFree3"]),
    ("AGPL-3.0-or-later", ["AGPLFree"]),
    ("Apache-2.0", ["ApacheGrant"]),
    ("MPL-2.0", ["MPLGrant"]),
    ("EPL-2.0", ["EPL2"]),
    ("CC-BY-NC-SA-4.0", ["CCBYNCSA4Text"]),
    ("CC-BY-NC-4.0", ["CCBYNC4Text"]),
    ("CC-BY-SA-4.0", ["CCBYSA4Text"]),
    ("CC-BY-ND-4.0", ["CCBYND4Text"]),
    ("CC-BY-4.0", ["CCBY4Text"]),
    ("CC0-1.0", ["CC0Text"]),
    ("MPL-2.0", ["MPL2"]),
    ("CC-BY-NC-SA-4.0", ["CCBYNCSA4"]),
    ("CC-BY-NC-4.0", ["CCBYNC4"]),
    ("CC-BY-SA-4.0", ["CCBYSA4"]),
    ("CC-BY-ND-4.0", ["CCBYND4"]),
    ("CC-BY-4.0", ["CCBY4"]),
    ("CC0-1.0", ["CC0"]),
    ("Unlicense", ["Unlicense"]),
    ("Public-Domain", ["PublicDomain"]),
    ("All-Rights-Reserved", ["Reserved"]),
]


def normal(sentence: str) -> str:
    return re.sub("[^a-z0-9]+", " ", sentence.lower()).strip(" ")


def known_sentences() -> dict[str, str]:
    """Normalised sentence -> identifier; sentence ends inside a sentence normalise away."""
    return {normal(text): name for name, text in SENTENCES}


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, sentence_ids, licenses, n_sentences, unmatched) of every row.

    ``sentence_ids``: identifiers in the order of the text; ``licenses``: those of the rules that
    matched, in the order of the rules, each once; both comma-joined. ``unmatched``: identifiers
    that no rule consumed. Texts without known sentences, empty and null ones have empty strings
    and 0. Equal rows get equal results; rows with a null id are kept.
    """
    spark, known = docs.sparkSession, known_sentences()
    table = F.broadcast(spark.createDataFrame([(s, n, max(1, len(s))) for s, n in known.items()], "sentence string, name string, chars int"))
    # A fragment that begins a sentence is a prefix of it in whole words, and each fragment has a word.
    words = [s.split(" ") for s in known]
    starts, most = "^(" + "|".join(sorted({w[0] for w in words})) + ")( |$)", max(map(len, words))
    padded = "array(" + ", ".join(f"'{s} '" for s in sorted(known)) + ")"
    rows = row_key(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), "id", "text")
    parts = F.transform(F.split(ascii_lower(F.coalesce("text", F.lit(""))), BREAKS), lambda x: F.trim(F.regexp_replace(x, "[^a-z0-9]+", " ")))
    # Bound once in a lambda, so that the fragments are not made anew for each place that looks at them.
    near = F.expr(f"""transform(array(parts), p -> flatten(transform(
        filter(sequence(0, size(p) - 1), i -> size(p) > 0 and rlike(p[i], '{starts}') and exists({padded}, s -> startswith(s, p[i] || ' '))),
        i -> transform(sequence(1, least({most}, size(p) - i)), n -> struct(i as i, n as n, array_join(slice(p, i + 1, n), ' ') as s)))))[0]""")
    cut = rows.select("__k", "__d", F.filter(parts, lambda x: x != "").alias("parts")).where("size(parts) > 0")
    runs = cut.select("__k", "__d", F.explode(near).alias("r"))
    found = runs.select("__k", "__d", "r.*").join(table, F.col("s") == F.col("sentence"))
    # Of sentences that begin at one place the longest holds.
    found = found.groupBy("__k", "__d", "i").agg(F.max(F.struct("n", "name")).alias("best"))
    sequences = found.groupBy("__k", "__d").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", F.col("best.name").alias("name")))), lambda x: x["name"]).alias("names"))
    rules = F.array(*[F.struct(F.lit(name).alias("name"), F.lit("," + ",,".join(ids) + ",").alias("ids")) for name, ids in RULES])
    # A comma on both sides of every identifier, so that neighbours do not share one.
    spaced = F.concat(F.lit(","), F.array_join("names", ",,"), F.lit(","))
    fold = F.aggregate(
        rules,
        F.struct(spaced.alias("left"), F.array().cast("array<string>").alias("got")),
        lambda acc, r: F.when(
            F.contains(acc["left"], r["ids"]),
            F.struct(F.replace(acc["left"], r["ids"], F.lit("")).alias("left"), F.array_append(acc["got"], r["name"]).alias("got")),
        ).otherwise(acc),
    )
    matched = sequences.select("__k", "__d", "names", fold.alias("x"))
    out = rows.select("id", "__k", "__d").join(matched, ["__k", "__d"], "left")
    left = F.filter(F.split("x.left", ","), lambda x: x != "")
    return out.select(
        "id",
        F.coalesce(F.array_join("names", ","), F.lit("")).alias("sentence_ids"),
        F.coalesce(F.array_join(F.array_distinct("x.got"), ","), F.lit("")).alias("licenses"),
        F.coalesce(F.size("names"), F.lit(0)).cast("long").alias("n_sentences"),
        F.coalesce(F.array_join(left, ","), F.lit("")).alias("unmatched"),
    )
