"""License scans by ordered signature rules.

Rules are regular expressions over a text's words (A-Z lower-cased, one space between words). Each has keywords that a
text must hold before the expression is tried, a priority, a confidence and a label. Hits are taken by priority, then
length; a hit inside one already taken is suppressed, which one sweep a priority finds in about linear time. Whole texts are read on bounded Arrow batches, without a shuffle.
"""

from __future__ import annotations

import heapq
import re
from dataclasses import dataclass
from itertools import groupby

from pyspark.sql import DataFrame

from .common import WORD_TABLE, map_texts

BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
BASE_CONFIDENCE = 0.9


@dataclass(frozen=True)
class Rule:
    label: str
    priority: int
    confidence: float
    keywords: tuple[str, ...]
    pattern: str


#: label; keyword; name in running text; SPDX identifier as words.
FAMILIES = (
    ("gpl-2.0", "gnu", r"gnu (?:general public licen[sc]e|gpl)(?: gpl)?(?: version| v)? ?2(?: 0)?", r"gpl 2 0(?: only| or later)?"),
    ("gpl-3.0", "gnu", r"gnu (?:general public licen[sc]e|gpl)(?: gpl)?(?: version| v)? ?3(?: 0)?", r"gpl 3 0(?: only| or later)?"),
    ("lgpl-2.1", "lesser", r"gnu lesser general public licen[sc]e(?: version| v)? ?2 1", r"lgpl 2 1(?: only| or later)?"),
    ("lgpl-3.0", "lesser", r"gnu lesser general public licen[sc]e(?: version| v)? ?3(?: 0)?", r"lgpl 3 0(?: only| or later)?"),
    ("lgpl-2.0", "library", r"gnu library general public licen[sc]e(?: version 2)?", r"lgpl 2 0(?: only| or later)?"),
    ("agpl-3.0", "affero", r"gnu affero general public licen[sc]e(?:(?: version| v)? ?3(?: 0)?)?", r"agpl 3 0(?: only| or later)?"),
    ("gfdl-1.3", "documentation", r"gnu free documentation licen[sc]e(?: version 1 [123])?", r"gfdl 1 [123](?: only| or later)?"),
    ("apache-2.0", "apache", r"apache (?:software )?licen[sc]e(?: version| v)? ?2(?: 0)?", r"apache 2 0"),
    ("apache-1.1", "apache", r"apache (?:software )?licen[sc]e(?: version| v)? ?1 1", r"apache 1 1"),
    ("apache-1.0", "apache", r"apache (?:software )?licen[sc]e(?: version| v)? ?1 0", r"apache 1 0"),
    ("mit", "mit", r"(?:the )?mit x?1?1? ?licen[sc]e", r"mit"),
    ("mit-0", "mit", r"mit no attribution(?: licen[sc]e)?", r"mit 0"),
    ("x11", "x11", r"x11 licen[sc]e", r"x11"),
    ("bsd-2-clause", "bsd", r"(?:simplified bsd|freebsd|bsd 2 clause)(?: licen[sc]e)?", r"bsd 2 clause"),
    ("bsd-3-clause", "bsd", r"(?:new bsd|modified bsd|revised bsd|bsd 3 clause)(?: licen[sc]e)?", r"bsd 3 clause"),
    ("bsd-4-clause", "bsd", r"(?:original bsd|bsd 4 clause)(?: licen[sc]e)?", r"bsd 4 clause"),
    ("0bsd", "bsd", r"(?:zero clause bsd|bsd zero clause)(?: licen[sc]e)?", r"0bsd"),
    ("isc", "isc", r"isc licen[sc]e", r"isc"),
    ("mpl-1.1", "mozilla", r"mozilla public licen[sc]e(?: version| v)? ?1 1", r"mpl 1 1"),
    ("mpl-2.0", "mozilla", r"mozilla public licen[sc]e(?: version| v)? ?2 0", r"mpl 2 0"),
    ("epl-1.0", "eclipse", r"eclipse public licen[sc]e(?: version| v)? ?1 0", r"epl 1 0"),
    ("epl-2.0", "eclipse", r"eclipse public licen[sc]e(?: version| v)? ?2 0", r"epl 2 0"),
    ("edl-1.0", "eclipse", r"eclipse distribution licen[sc]e(?: version| v)? ?1 0", r"edl 1 0"),
    ("cddl-1.0", "cddl", r"(?:common development and distribution licen[sc]e|cddl)(?: version| v)? ?1 0", r"cddl 1 0"),
    ("cddl-1.1", "cddl", r"(?:common development and distribution licen[sc]e|cddl)(?: version| v)? ?1 1", r"cddl 1 1"),
    ("cpl-1.0", "common", r"common public licen[sc]e(?: version| v)?(?: 1 0)?", r"cpl 1 0"),
    ("ipl-1.0", "ibm", r"ibm public licen[sc]e(?: version| v)?(?: 1 0)?", r"ipl 1 0"),
    ("osl-3.0", "open", r"open software licen[sc]e(?: version| v)? ?3 0", r"osl 3 0"),
    ("afl-3.0", "academic", r"academic free licen[sc]e(?: version| v)? ?3 0", r"afl 3 0"),
    ("artistic-1.0", "artistic", r"artistic licen[sc]e(?: version)? ?1 0", r"artistic 1 0"),
    ("artistic-2.0", "artistic", r"artistic licen[sc]e(?: version)? ?2 0", r"artistic 2 0"),
    ("zlib", "zlib", r"zlib(?: libpng)? licen[sc]e", r"zlib"),
    ("libpng", "libpng", r"libpng licen[sc]e", r"libpng"),
    ("bsl-1.0", "boost", r"boost software licen[sc]e(?: version)?(?: 1 0)?", r"bsl 1 0"),
    ("unlicense", "unlicense", r"the unlicense", r"unlicense"),
    ("wtfpl", "wtfpl", r"wtfpl", r"wtfpl"),
    ("ncsa", "ncsa", r"university of illinois ncsa open source licen[sc]e", r"ncsa"),
    ("postgresql", "postgresql", r"postgresql licen[sc]e", r"postgresql"),
    ("python-2.0", "python", r"python software foundation licen[sc]e", r"python 2 0"),
    ("php-3.01", "php", r"php licen[sc]e(?: version)?(?: 3 01)?", r"php 3 01"),
    ("ruby", "ruby", r"ruby licen[sc]e", r"ruby"),
    ("openssl", "openssl", r"openssl licen[sc]e", r"openssl"),
    ("upl-1.0", "universal", r"universal permissive licen[sc]e(?: version)?(?: 1 0)?", r"upl 1 0"),
    ("ms-pl", "microsoft", r"microsoft public licen[sc]e", r"ms pl"),
    ("ms-rl", "microsoft", r"microsoft reciprocal licen[sc]e", r"ms rl"),
    ("eupl-1.2", "european", r"european union public licen[sc]e(?: version| v)?(?: 1 2)?", r"eupl 1 2"),
    ("ofl-1.1", "sil", r"sil open font licen[sc]e(?: version)?(?: 1 1)?", r"ofl 1 1"),
    ("bsl-1.1", "business", r"business source licen[sc]e(?: version)?(?: 1 1)?", r"busl 1 1"),
    ("sspl-1.0", "server", r"server side public licen[sc]e(?: version)?(?: 1)?", r"sspl 1 0"),
    ("elastic-2.0", "elastic", r"elastic licen[sc]e(?: version)?(?: 2 0)?", r"elastic 2 0"),
    ("odbl-1.0", "database", r"open (?:data commons open )?database licen[sc]e", r"odbl 1 0"),
    ("pddl-1.0", "public", r"public domain dedication and licen[sc]e", r"pddl 1 0"),
    ("cc0-1.0", "cc0", r"(?:creative commons )?cc0(?: 1 0)?(?: universal)?", r"cc0 1 0"),
    ("cc-by-4.0", "by", r"(?:cc|creative commons) by 4 0|creative commons attribution 4 0(?: international)?", r"cc by 4 0"),
    ("cc-by-sa", "by", r"(?:cc|creative commons) by sa(?: [1-4] [05])?|creative commons attribution share ?alike(?: [1-4] [05])?", r"cc by sa [1-4] [05]"),
    ("cc-by-nd", "by", r"(?:cc|creative commons) by nd(?: [1-4] [05])?|creative commons attribution no ?deriv(?:ative)?s(?: [1-4] [05])?", r"cc by nd [1-4] [05]"),
    ("cc-by-nc", "by", r"(?:cc|creative commons) by nc(?: [1-4] [05])?(?! (?:sa|nd)\b)|creative commons attribution non ?commercial(?: [1-4] [05])?", r"cc by nc [1-4] [05]"),
    ("cc-by-nc-sa", "by", r"(?:cc|creative commons) by nc sa(?: [1-4] [05])?|creative commons attribution non ?commercial share ?alike(?: [1-4] [05])?", r"cc by nc sa [1-4] [05]"),
    ("cc-by-nc-nd", "by", r"(?:cc|creative commons) by nc nd(?: [1-4] [05])?|creative commons attribution non ?commercial no ?deriv(?:ative)?s(?: [1-4] [05])?", r"cc by nc nd [1-4] [05]"),
)
#: label; priority; confidence; keywords; expression: passages of the licenses themselves.
PASSAGES = (
    ("mit", 80, 0.95, ("permission", "deal"), r"permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("mit", 40, 0.8, ("substantial",), r"shall be included in all copies or substantial portions of the software"),
    ("isc", 80, 0.95, ("permission", "fee"), r"permission to use copy modify and or distribute this software for any purpose with or without fee"),
    ("bsd", 80, 0.9, ("redistribution",), r"redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd-3-clause", 82, 0.95, ("endorse",), r"neither the name of .{1,120}? may be used to endorse or promote products derived from this software"),
    ("bsd-4-clause", 84, 0.95, ("advertising",), r"all advertising materials mentioning features or use of this software must display"),
    ("apache-2.0", 80, 0.98, ("apache", "compliance"), r"you may not use this file except in compliance with the licen[sc]e"),
    ("gpl", 80, 0.95, ("redistribute", "gnu"), r"you can redistribute it and or modify it under the terms of the gnu general public licen[sc]e"),
    ("lgpl", 82, 0.95, ("redistribute", "lesser"), r"you can redistribute it and or modify it under the terms of the gnu lesser general public licen[sc]e"),
    ("agpl", 82, 0.95, ("redistribute", "affero"), r"you can redistribute it and or modify it under the terms of the gnu affero general public licen[sc]e"),
    ("gpl", 40, 0.7, ("gnu",), r"either version [23] of the licen[sc]e or (?:at your option )?any later version"),
    ("mpl-2.0", 80, 0.98, ("mozilla",), r"this source code form is subject to the terms of the mozilla public licen[sc]e"),
    ("unlicense", 80, 0.95, ("unencumbered",), r"this is free and unencumbered software released into the public domain"),
    ("zlib", 80, 0.9, ("misrepresented",), r"the origin of this software must not be misrepresented"),
    ("bsl-1.0", 80, 0.95, ("boost",), r"distributed under the boost software licen[sc]e"),
    ("wtfpl", 80, 0.9, ("fuck",), r"do what the fuck you want to public licen[sc]e"),
    ("cc0-1.0", 80, 0.9, ("waived",), r"waived all copyright and related or neighboring rights"),
    ("public-domain", 30, 0.7, ("domain",), r"(?:released|placed|dedicated) (?:in|into|to) the public domain"),
    ("all-rights-reserved", 20, 0.6, ("reserved",), r"all rights reserved"),
    ("copyright", 10, 0.4, ("copyright",), r"copyright (?:c )?(?:19|20)[0-9]{2}"),
    ("proprietary", 30, 0.7, ("proprietary",), r"proprietary and confidential"),
    ("non-commercial", 30, 0.7, ("commercial",), r"for non ?commercial (?:use|purposes) only"),
    ("no-redistribution", 30, 0.7, ("written",), r"may not be (?:reproduced|redistributed|copied) without (?:prior |express )?written permission"),
    ("mit", 42, 0.85, ("merchantability", "noninfringement"), r"the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability"),
    ("mit", 41, 0.85, ("sublicense", "sell"), r"without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies"),
    ("mit", 38, 0.7, ("liable", "tort"), r"be liable for any claim damages or other liability whether in an action of contract tort or otherwise"),
    ("mit-0", 83, 0.95, ("deal",), r"permission is hereby granted free of charge to any person obtaining a copy of this software .{1,90}? to deal in the software without restriction (?:.{1,160}? )?and to permit persons to whom the software is furnished to do so the software is provided"),
    ("isc", 41, 0.8, ("disclaims",), r"the author disclaims all warranties with regard to this software"),
    ("bsd", 42, 0.8, ("redistributions",), r"redistributions of source code must retain the above copyright notice"),
    ("bsd", 42, 0.8, ("redistributions",), r"redistributions in binary form must reproduce the above copyright notice"),
    ("bsd", 40, 0.75, ("contributors",), r"this software is provided by the (?:copyright holders and contributors|regents and contributors|author) as is"),
    ("bsd-1-clause", 81, 0.7, ("redistributions",), r"redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer this software is provided"),
    ("apache-2.0", 45, 0.9, ("apache",), r"www apache org licen[sc]es licen[sc]e 2 0"),
    ("apache-2.0", 42, 0.85, ("conditions",), r"distributed under the licen[sc]e is distributed on an as is basis without warranties or conditions of any kind"),
    ("apache-2.0", 41, 0.85, ("limitations",), r"see the licen[sc]e for the specific language governing permissions and limitations under the licen[sc]e"),
    ("apache-1.1", 82, 0.95, ("apache", "acknowledgment"), r"this product includes software developed by the apache software foundation"),
    ("gpl", 45, 0.8, ("gnu",), r"you should have received a copy of the gnu general public licen[sc]e"),
    ("lgpl", 45, 0.8, ("gnu", "lesser"), r"you should have received a copy of the gnu lesser general public licen[sc]e"),
    ("agpl", 45, 0.8, ("gnu", "affero"), r"you should have received a copy of the gnu affero general public licen[sc]e"),
    ("gpl", 40, 0.75, ("gnu", "merchantability"), r"without even the implied warranty of merchantability or fitness for a particular purpose see the gnu (?:lesser |affero )?general public licen[sc]e"),
    ("gpl", 35, 0.7, ("copyleft",), r"gnu general public licen[sc]e is a free copyleft licen[sc]e"),
    ("gpl", 33, 0.6, ("gpl",), r"gpl ?v ?[23](?: or later)?"),
    ("lgpl", 33, 0.6, ("lgpl",), r"lgpl ?v ?[23](?: 1)?(?: or later)?"),
    ("agpl", 33, 0.6, ("agpl",), r"agpl ?v ?3(?: or later)?"),
    ("gpl-2.0", 86, 0.95, ("gnu", "1991"), r"gnu general public licen[sc]e version 2 june 1991"),
    ("gpl-3.0", 86, 0.95, ("gnu", "2007"), r"gnu general public licen[sc]e version 3 29 june 2007"),
    ("lgpl-2.1", 86, 0.95, ("lesser", "1999"), r"gnu lesser general public licen[sc]e version 2 1 february 1999"),
    ("lgpl-3.0", 86, 0.95, ("lesser", "2007"), r"gnu lesser general public licen[sc]e version 3 29 june 2007"),
    ("agpl-3.0", 86, 0.95, ("affero", "2007"), r"gnu affero general public licen[sc]e version 3 19 november 2007"),
    ("gpl-1.0", 86, 0.95, ("gnu", "1989"), r"gnu general public licen[sc]e version 1 february 1989"),
    ("gfdl", 82, 0.95, ("documentation", "invariant"), r"permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation licen[sc]e"),
    ("gfdl", 35, 0.6, ("invariant",), r"with no invariant sections no front cover texts and no back cover texts"),
    ("classpath-exception", 84, 0.9, ("executable", "linking"), r"linking this library statically or dynamically with other modules is making a combined work"),
    ("gcc-exception", 84, 0.9, ("gcc",), r"gcc runtime library exception(?: version 3 1)?"),
    ("llvm-exception", 84, 0.9, ("llvm",), r"apache licen[sc]e (?:version |v)?2 0 with llvm exceptions?"),
    ("openssl-exception", 84, 0.9, ("openssl",), r"permission to link the code of (?:portions of )?this program with the openssl library"),
    ("font-exception", 84, 0.9, ("font",), r"as a special exception if you create a document which uses this font"),
    ("mpl-2.0", 45, 0.9, ("mozilla",), r"mozilla org mpl 2 0"),
    ("mpl-1.1", 80, 0.95, ("mozilla", "contents"), r"the contents of this file are subject to the mozilla public licen[sc]e version 1 1"),
    ("epl-1.0", 80, 0.95, ("eclipse", "accompanying"), r"this program and the accompanying materials are made available under the terms of the eclipse public licen[sc]e v?(?:ersion )?1 0"),
    ("epl-2.0", 80, 0.95, ("eclipse", "accompanying"), r"this program and the accompanying materials are made available under the terms of the eclipse public licen[sc]e (?:v )?2 0"),
    ("cddl-1.0", 80, 0.95, ("cddl",), r"the contents of this file are subject to the terms of the common development and distribution licen[sc]e"),
    ("artistic-2.0", 80, 0.9, ("artistic",), r"under the same terms as perl itself or the artistic licen[sc]e"),
    ("perl", 60, 0.85, ("perl",), r"(?:under )?the same terms as perl(?: 5)?(?: itself)?"),
    ("zlib", 42, 0.85, ("altered",), r"altered source versions must be plainly marked as such"),
    ("zlib", 42, 0.85, ("arising",), r"in no event will the authors be held liable for any damages arising from the use of this software"),
    ("unlicense", 42, 0.85, ("unlicense",), r"unlicense org"),
    ("unlicense", 42, 0.85, ("copyright", "dedicate"), r"the author or authors of this software dedicate any and all copyright interest in the software to the public domain"),
    ("cc0-1.0", 82, 0.95, ("dedicated",), r"dedicated the work to the public domain by waiving all of (?:his or her|their) rights"),
    ("cc0-1.0", 45, 0.9, ("publicdomain",), r"creativecommons org publicdomain zero 1 0"),
    ("cc-by-4.0", 45, 0.9, ("creativecommons",), r"creativecommons org licen[sc]es by 4 0"),
    ("cc-by-3.0", 45, 0.9, ("creativecommons",), r"creativecommons org licen[sc]es by 3 0"),
    ("cc-by-sa", 45, 0.9, ("creativecommons",), r"creativecommons org licen[sc]es by sa [1-4] [05]"),
    ("cc-by-nd", 45, 0.9, ("creativecommons",), r"creativecommons org licen[sc]es by nd [1-4] [05]"),
    ("cc-by-nc", 45, 0.9, ("creativecommons",), r"creativecommons org licen[sc]es by nc [1-4] [05]"),
    ("cc-by-nc-sa", 45, 0.9, ("creativecommons",), r"creativecommons org licen[sc]es by nc sa [1-4] [05]"),
    ("cc-by-nc-nd", 45, 0.9, ("creativecommons",), r"creativecommons org licen[sc]es by nc nd [1-4] [05]"),
    ("creative-commons", 15, 0.5, ("commons",), r"creative commons(?: licen[sc]e)?"),
    ("odbl-1.0", 45, 0.9, ("opendatacommons",), r"opendatacommons org licen[sc]es odbl"),
    ("odc-by-1.0", 50, 0.9, ("commons", "attribution"), r"open data commons attribution licen[sc]e(?: v(?:ersion )?1 0)?"),
    ("cdla-permissive", 50, 0.9, ("community", "permissive"), r"community data licen[sc]e agreement permissive(?: version)?(?: [12] 0)?"),
    ("cdla-sharing", 50, 0.9, ("community", "sharing"), r"community data licen[sc]e agreement sharing(?: version)?(?: 1 0)?"),
    ("beerware", 80, 0.9, ("beer",), r"you can buy me a beer in return"),
    ("beerware", 50, 0.85, ("beer",), r"the beer ?ware licen[sc]e(?: revision 42)?"),
    ("json", 80, 0.9, ("evil",), r"the software shall be used for good not evil"),
    ("curl", 80, 0.9, ("curl",), r"curl licen[sc]e|copyright c 1996 20[0-9]{2} daniel stenberg"),
    ("ijg", 80, 0.9, ("jpeg",), r"this software is based in part on the work of the independent jpeg group"),
    ("unicode", 80, 0.9, ("unicode",), r"unicode (?:inc )?licen[sc]e agreement data files and software"),
    ("w3c", 80, 0.9, ("w3c",), r"w3c software (?:and document )?(?:notice and )?licen[sc]e"),
    ("vim", 80, 0.9, ("vim",), r"vim licen[sc]e"),
    ("tcl", 80, 0.85, ("tcl",), r"tcl tk licen[sc]e|tcl licen[sc]e"),
    ("ecl-2.0", 80, 0.9, ("educational",), r"educational community licen[sc]e(?: version)?(?: 2 0)?"),
    ("cecill", 80, 0.9, ("cecill",), r"cecill(?: [bc])?(?: free software)?(?: licen[sc]e)?(?: agreement)?(?: version)?(?: [12] [01])?"),
    ("mulan-psl-2.0", 80, 0.9, ("mulan",), r"mulan permissive software licen[sc]e(?: version)?(?: 2)?"),
    ("polyform", 80, 0.9, ("polyform",), r"polyform (?:noncommercial|small business|shield|perimeter|strict)(?: licen[sc]e)?(?: 1 0 0)?"),
    ("commons-clause", 80, 0.9, ("commons", "clause"), r"commons clause licen[sc]e condition(?: v(?:ersion )?1 0)?"),
    ("openrail", 80, 0.9, ("rail",), r"(?:creativeml |bigscience |bigcode )?open ?rail(?: [ms])?(?: licen[sc]e)?"),
    ("public-domain", 28, 0.65, ("domain",), r"this (?:file|work|software|program|code) is in the public domain"),
    ("public-domain", 27, 0.6, ("government",), r"work of the (?:united states|us|u s) government"),
    ("proprietary", 28, 0.65, ("confidential",), r"confidential and proprietary (?:information|property|material)s?"),
    ("proprietary", 28, 0.65, ("unauthorized",), r"unauthorized (?:copying|use|reproduction|distribution) of this (?:file|software|document|work)(?: .{1,40}?)? is (?:strictly )?prohibited"),
    ("proprietary", 26, 0.6, ("trade",), r"contains trade secrets(?: and confidential information)?"),
    ("end-user-licence", 30, 0.7, ("end", "user"), r"end user licen[sc]e agreement"),
    ("evaluation-only", 30, 0.7, ("evaluation",), r"for evaluation (?:use|purposes) only"),
    ("research-only", 30, 0.7, ("research",), r"for (?:academic and |non ?commercial )?research (?:use|purposes) only"),
    ("personal-use", 30, 0.7, ("personal",), r"for personal(?: and)?(?: non ?commercial)? use only"),
    ("no-derivatives", 28, 0.65, ("derivative",), r"you may not (?:create|make|prepare|distribute) derivative works"),
    ("attribution-required", 25, 0.55, ("attribution",), r"(?:proper )?attribution is required"),
    ("permission-granted", 12, 0.4, ("permission",), r"(?:used|reprinted|reproduced) (?:with|by) (?:kind )?permission(?: of)?"),
    ("copyright", 11, 0.45, ("copyright", "holder"), r"all copyright holders?|the copyright holders?"),
)
_LEAD = r"(?:licen[sc]ed|released|distributed|available|provided|published|shared) under (?:the )?(?:terms of (?:the )?)?(?:an? )?"


def _rules() -> tuple[Rule, ...]:
    out = [Rule(label, p, c, keys, text) for label, p, c, keys, text in PASSAGES]
    for label, key, name, spdx in FAMILIES:
        out += [
            Rule(label, 90, 1.0, ("spdx",), rf"spdx licen[sc]e identifier (?:{spdx})"),
            Rule(label, 70, 0.97, (key, "under"), rf"{_LEAD}(?:{name})"),
            Rule(label, 60, 0.95, (key, "terms"), rf"(?:subject to|governed by) (?:the )?terms of (?:the )?(?:{name})"),
            Rule(label, 50, 0.85, (key,), rf"(?:{name})"),
        ]
    return tuple(sorted(out, key=lambda r: -r.priority))


RULES = _rules()


def uncontained(hits: list[tuple], outer: list[tuple[int, int]]) -> list[tuple]:
    """Of hits (start, -end, label, confidence), those inside no longer one of them, no equal one before and none of outer, by start.

    outer: (start, end), none inside another, by start. One sweep over both: a hit is inside an earlier start's interval if it ends no later.
    """
    out, far, k = [], -1, 0
    for hit in sorted(hits):
        start, end = hit[0], -hit[1]
        while k < len(outer) and outer[k][0] <= start:
            far, k = max(far, outer[k][1]), k + 1
        if far < end:
            out.append(hit)
            far = end
    return out


def merged(outer: list[tuple[int, int]], hits: list[tuple]) -> list[tuple[int, int]]:
    """outer with uncontained hits, without what is now inside another, by start."""
    out, far = [], -1
    for start, below in heapq.merge([(a, -b) for a, b in outer], [h[:2] for h in hits]):
        if -below > far:
            far = -below
            out.append((start, far))
    return out


def scanner(rules: tuple[Rule, ...] = RULES):
    """A function from a text to (n_words, n_base, first_word, last_word, base_labels, labels, score)."""
    compiled = [(r, tuple(k.encode() for k in r.keywords), re.compile(rf"(?<= )(?:{r.pattern})(?= )".encode())) for r in sorted(rules, key=lambda r: -r.priority)]
    keywords = sorted({k for _, keys, _ in compiled for k in keys})
    phrases = [(f" {p} ".encode(), label) for p, label in BASE.items()]

    def scan(text):
        words = (text or "").encode("utf-8", "surrogatepass").translate(WORD_TABLE).split()
        line = b" " + b" ".join(words) + b" "
        places, base = [], set()
        for phrase, label in phrases:
            at = line.find(phrase)
            while at >= 0:
                places.append(at)
                base.add(label)
                at = line.find(phrase, at + 1)
        there = {k for k in keywords if k in line}
        labels, score = set(base), BASE_CONFIDENCE if base else 0.0
        outer: list[tuple[int, int]] = []
        for _, level in groupby((x for x in compiled if there.issuperset(x[1])), key=lambda x: x[0].priority):
            hits = [(m.start(), -m.end(), rule.label, rule.confidence) for rule, _, pattern in level for m in pattern.finditer(line)]
            taken = uncontained(hits, outer)
            labels.update(h[2] for h in taken)
            score = max([score, *(h[3] for h in taken)])
            outer = merged(outer, taken)
        first, last = (line.count(b" ", 0, min(places)), line.count(b" ", 0, max(places))) if places else (None, None)
        return len(words), len(places), first, last, ",".join(sorted(base)), ",".join(sorted(labels)), score

    return scan


def scan_licenses(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score for every row of docs (doc_id, text).

    Null and empty texts have no words, no labels (empty strings), no places (null) and score 0. Repeated rows and null
    ids are kept; an empty table gives an empty result. Other columns are ignored.
    """

    def make():
        import pyarrow as pa

        scan = scanner()
        types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64())
        return lambda texts: [pa.array(x, t) for x, t in zip(zip(*map(scan, texts)), types)]

    return map_texts(docs, ["doc_id"], make, "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double")
