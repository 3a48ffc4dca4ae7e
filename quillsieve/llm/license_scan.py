"""License detection by ordered signature rules; DataFrame functions only.

A text's words (digits, letters, anything beyond ASCII; A-Z lowered) are joined by one space. A
rule is a hand-written pattern over that line of words, a keyword that each of its matches
contains, a priority and a confidence; the order of the table decides within a priority. Texts
without any of ROOTS skip the rules; the others run the rules whose keyword they contain, each as a
literal pattern that is compiled once a task; only the rules that match are then placed.

A detection is an interval of words. It is suppressed where a detection of the same or a higher
priority contains it; of equal intervals the rule that comes first stays. A detection of a lower
priority never suppresses one of a higher: a sentence of a license text that names another license
hides the name, a copyright notice around it doesn't.
Everything happens within a row: nothing is shuffled and no text is sent to Python.

Base places are where the words of a base phrase stand one after the other; their labels stay
whatever the rules suppress.

Defined results: a null text is empty; a text without detections has empty labels and score 0;
repeated rows get equal results; other columns are ignored by ``digests`` and kept by ``scan``,
which replaces columns named n_words, base and detections.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillsieve.llm.arrays import quoted

#: phrase and label, as given.
BASE = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]
#: Each match of each rule contains one of these.
ROOTS = ["licen", "copyright", "copyleft", "spdx", "gpl", "redistribut", "commons", "warrant", "rights", "domain", "permission", "proprietary", "apache", "mozilla", "advertising"]
#: Not in words: ASCII other than digits and letters.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

#: priority | confidence | label | keyword | pattern over words. Lines that begin with # are notes.
RULES = r"""
# 1: identifiers and headers that name one license
1 | 0.98 | mit | spdx | spdx licen[sc]e identifier mit
1 | 0.98 | mit-0 | spdx | spdx licen[sc]e identifier mit 0
1 | 0.98 | apache-2.0 | spdx | spdx licen[sc]e identifier apache 2 0
1 | 0.98 | apache-1.1 | spdx | spdx licen[sc]e identifier apache 1 1
1 | 0.98 | bsd-2-clause | spdx | spdx licen[sc]e identifier bsd 2 clause
1 | 0.98 | bsd-3-clause | spdx | spdx licen[sc]e identifier bsd 3 clause
1 | 0.98 | bsd-4-clause | spdx | spdx licen[sc]e identifier bsd 4 clause
1 | 0.98 | 0bsd | spdx | spdx licen[sc]e identifier 0bsd
1 | 0.98 | isc | spdx | spdx licen[sc]e identifier isc
1 | 0.98 | zlib | spdx | spdx licen[sc]e identifier zlib
1 | 0.98 | unlicense | spdx | spdx licen[sc]e identifier unlicense
1 | 0.98 | cc0-1.0 | spdx | spdx licen[sc]e identifier cc0 1 0
1 | 0.98 | cc-by-4.0 | spdx | spdx licen[sc]e identifier cc by 4 0
1 | 0.98 | cc-by-sa-4.0 | spdx | spdx licen[sc]e identifier cc by sa 4 0
1 | 0.98 | mpl-2.0 | spdx | spdx licen[sc]e identifier mpl 2 0
1 | 0.98 | epl-2.0 | spdx | spdx licen[sc]e identifier epl 2 0
1 | 0.98 | bsl-1.0 | spdx | spdx licen[sc]e identifier bsl 1 0
1 | 0.98 | gpl-2.0-or-later | spdx | spdx licen[sc]e identifier gpl 2 0 or later
1 | 0.98 | gpl-2.0 | spdx | spdx licen[sc]e identifier gpl 2 0(?: only)?
1 | 0.98 | gpl-3.0-or-later | spdx | spdx licen[sc]e identifier gpl 3 0 or later
1 | 0.98 | gpl-3.0 | spdx | spdx licen[sc]e identifier gpl 3 0(?: only)?
1 | 0.98 | lgpl-2.1-or-later | spdx | spdx licen[sc]e identifier lgpl 2 1 or later
1 | 0.98 | lgpl-2.1 | spdx | spdx licen[sc]e identifier lgpl 2 1(?: only)?
1 | 0.98 | lgpl-3.0-or-later | spdx | spdx licen[sc]e identifier lgpl 3 0 or later
1 | 0.98 | lgpl-3.0 | spdx | spdx licen[sc]e identifier lgpl 3 0(?: only)?
1 | 0.98 | agpl-3.0-or-later | spdx | spdx licen[sc]e identifier agpl 3 0 or later
1 | 0.98 | agpl-3.0 | spdx | spdx licen[sc]e identifier agpl 3 0(?: only)?
1 | 0.8 | spdx-other | spdx | spdx licen[sc]e identifier
1 | 0.95 | apache-2.0 | apache | www apache org licen[sc]es licen[sc]e 2 0
1 | 0.95 | gpl | gnu | www gnu org licen[sc]es gpl(?: html)?
1 | 0.95 | lgpl | gnu | www gnu org licen[sc]es lgpl(?: html)?
1 | 0.95 | agpl | gnu | www gnu org licen[sc]es agpl(?: html)?
1 | 0.95 | mit | opensource | opensource org licen[sc]es mit(?: licen[sc]e)?(?: php)?
1 | 0.95 | bsd | opensource | opensource org licen[sc]es bsd(?: licen[sc]e)?(?: php)?
1 | 0.95 | cc-by-4.0 | creativecommons | creativecommons org licen[sc]es by 4 0
1 | 0.95 | cc-by-3.0 | creativecommons | creativecommons org licen[sc]es by 3 0
1 | 0.95 | cc-by-sa-4.0 | creativecommons | creativecommons org licen[sc]es by sa 4 0
1 | 0.95 | cc-by-sa-3.0 | creativecommons | creativecommons org licen[sc]es by sa 3 0
1 | 0.95 | cc-by-nc-4.0 | creativecommons | creativecommons org licen[sc]es by nc 4 0
1 | 0.95 | cc-by-nc-sa-4.0 | creativecommons | creativecommons org licen[sc]es by nc sa 4 0
1 | 0.95 | cc-by-nc-nd-4.0 | creativecommons | creativecommons org licen[sc]es by nc nd 4 0
1 | 0.95 | cc-by-nd-4.0 | creativecommons | creativecommons org licen[sc]es by nd 4 0
1 | 0.95 | cc0-1.0 | creativecommons | creativecommons org publicdomain zero 1 0
1 | 0.95 | mpl-2.0 | mozilla | mozilla org mpl 2 0
# 2: sentences of license texts
2 | 0.95 | mit | hereby granted | permission is hereby granted free of charge to any person obtaining a copy(?: of this software and associated documentation files)?
2 | 0.9 | mit | permission notice | the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software
2 | 0.95 | isc | hereby granted | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
2 | 0.9 | hpnd | hereby granted | permission to use copy modify and distribute this software and its documentation for any purpose(?: and without fee)? is hereby granted
2 | 0.9 | bsd | redistribution and use | redistribution and use in source and binary forms with or without modification are permitted
2 | 0.9 | bsd-3-clause | endorse or promote | neither the name of .{1,120} nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission
2 | 0.9 | bsd-4-clause | advertising materials | all advertising materials mentioning features or use of this software must display the following acknowledge?ment
2 | 0.8 | bsd | redistributions of source | redistributions of source code must retain the above copyright notice
2 | 0.8 | bsd | redistributions in binary | redistributions in binary form must reproduce the above copyright notice
2 | 0.95 | apache-2.0 | apache | licen[sc]ed under the apache licen[sc]e version 2 0(?: the licen[sc]e)? you may not use this file except in compliance with the licen[sc]e
2 | 0.95 | apache-2.0 | except in compliance | you may not use this file except in compliance with the licen[sc]e
2 | 0.95 | gpl-2.0-or-later | redistribute it | redistribute it and or modify it under the terms of the gnu general public licen[sc]e as published by the free software foundation either version 2 of the licen[sc]e or(?: at your option)? any later version
2 | 0.95 | gpl-3.0-or-later | redistribute it | redistribute it and or modify it under the terms of the gnu general public licen[sc]e as published by the free software foundation either version 3 of the licen[sc]e or(?: at your option)? any later version
2 | 0.95 | lgpl | redistribute it | redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public licen[sc]e
2 | 0.95 | agpl | redistribute it | redistribute it and or modify it under the terms of the gnu affero general public licen[sc]e
2 | 0.95 | gpl | redistribute it | redistribute it and or modify it under the terms of the gnu general public licen[sc]e
2 | 0.85 | gpl | general public | you should have received a copy of the gnu general public licen[sc]e along with this program
2 | 0.85 | lgpl | general public | you should have received a copy of the gnu lesser general public licen[sc]e along with this (?:library|program)
2 | 0.85 | agpl | general public | you should have received a copy of the gnu affero general public licen[sc]e along with this program
2 | 0.95 | mpl-2.0 | mozilla | this source code form is subject to the terms of the mozilla public licen[sc]e v 2 0
2 | 0.95 | mpl-1.1 | mozilla | the contents of this file are subject to the mozilla public licen[sc]e version 1 1
2 | 0.95 | epl-1.0 | eclipse | (?:all rights reserved )?this program and the accompanying materials are made available under the terms of the eclipse public licen[sc]e v1 0
2 | 0.95 | epl-2.0 | eclipse | this program and the accompanying materials are made available under the terms of the eclipse public licen[sc]e (?:v )?2 0
2 | 0.95 | zlib | misrepresented | the origin of this software must not be misrepresented you must not claim that you wrote the original software.{0,400} this notice may not be removed or altered from any source (?:distribution|redistribution) .{0,80}licen[sc]e
2 | 0.95 | unlicense | public domain | this is free and unencumbered software released into the public domain
2 | 0.95 | wtfpl | everyone is permitted | everyone is permitted to copy and distribute verbatim or modified copies of this licen[sc]e document
2 | 0.95 | bsl-1.0 | boost | distributed under the boost software licen[sc]e version 1 0
2 | 0.9 | gfdl | document under the terms | permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation licen[sc]e
2 | 0.9 | ofl-1.1 | open font | this font software is licen[sc]ed under the sil open font licen[sc]e version 1 1
2 | 0.9 | cc0-1.0 | waived | to the extent possible under law .{1,120} has waived all copyright and related or neighboring rights
2 | 0.9 | cc-by-sa | share | creative commons attribution share ?alike licen[sc]e additional terms may apply
2 | 0.9 | json | for good not evil | the software shall be used for good not evil .{0,200}warrant(?:y|ies)
2 | 0.9 | openssl | openssl toolkit | this product includes software developed by the openssl project for use in the openssl toolkit .{0,200}licen[sc]e
2 | 0.85 | python-2.0 | python software | the python software foundation psf is making python available to licen[sc]ee
2 | 0.85 | artistic-2.0 | artistic | you may distribute under the terms of (?:either the gnu general public licen[sc]e or )?the artistic licen[sc]e(?: 2 0)?
# 3: names with a version or a variant
3 | 1.0 | mit-0 | mit no attribution | mit no attribution(?: licen[sc]e)?(?: mit 0)? licen[sc]e
3 | 0.9 | mit-0 | mit 0 | mit 0 licen[sc]e
3 | 0.9 | x11 | x11 | (?:mit )?x11 licen[sc]e
3 | 0.9 | mit | expat | (?:mit )?expat licen[sc]e
3 | 0.9 | 0bsd | bsd | (?:zero clause|0) ?bsd licen[sc]e
3 | 0.95 | bsd-2-clause | bsd | (?:bsd 2 clause|2 clause bsd|two clause bsd) licen[sc]e
3 | 0.95 | bsd-3-clause | bsd | (?:bsd 3 clause|3 clause bsd|three clause bsd) licen[sc]e
3 | 0.95 | bsd-4-clause | bsd | (?:bsd 4 clause|4 clause bsd|four clause bsd) licen[sc]e
3 | 0.9 | bsd-2-clause | bsd | (?:simplified bsd|freebsd) licen[sc]e
3 | 0.9 | bsd-3-clause | bsd | (?:new|modified|revised) bsd licen[sc]e
3 | 0.9 | bsd-4-clause | bsd | (?:original|old) bsd licen[sc]e
3 | 0.95 | apache-1.0 | apache | apache (?:software )?licen[sc]e(?: v| version)? 1 0
3 | 0.95 | apache-1.1 | apache | apache (?:software )?licen[sc]e(?: v| version)? 1 1
3 | 0.95 | apache-2.0 | apache | apache (?:software )?licen[sc]e(?: v| version)? 2(?: 0)?
3 | 0.95 | apache-2.0 | apache | apache (?:software )?licen[sc]e v2(?: 0)?
3 | 0.9 | apache-2.0 | apache | apache v?2(?: 0)?(?: licen[sc]e)?
3 | 0.95 | gpl-1.0 | general public | (?:gnu )?general public licen[sc]e (?:v ?|version )?1(?: 0)?
3 | 0.95 | gpl-2.0-or-later | general public | (?:gnu )?general public licen[sc]e (?:v ?|version )?2(?: 0)?(?: or(?: at your option)?(?: any)? later(?: version)?)
3 | 0.95 | gpl-2.0 | general public | (?:gnu )?general public licen[sc]e (?:v ?|version )?2(?: 0)?(?: only)?
3 | 0.95 | gpl-3.0-or-later | general public | (?:gnu )?general public licen[sc]e (?:v ?|version )?3(?: 0)?(?: or(?: at your option)?(?: any)? later(?: version)?)
3 | 0.95 | gpl-3.0 | general public | (?:gnu )?general public licen[sc]e (?:v ?|version )?3(?: 0)?(?: only)?
3 | 0.9 | gpl-2.0-or-later | gpl | (?:gnu )?gpl ?v? ?2(?: 0)? or(?: any)? later
3 | 0.9 | gpl-3.0-or-later | gpl | (?:gnu )?gpl ?v? ?3(?: 0)? or(?: any)? later
3 | 0.85 | gpl-2.0 | gpl | (?:gnu )?gpl ?v? ?2(?: 0)?(?: only)?
3 | 0.85 | gpl-3.0 | gpl | (?:gnu )?gpl ?v? ?3(?: 0)?(?: only)?
3 | 0.95 | lgpl-2.0 | library general | (?:gnu )?library general public licen[sc]e(?: (?:v ?|version )?2(?: 0)?)?
3 | 0.95 | lgpl-2.1 | lesser general | (?:gnu )?lesser general public licen[sc]e (?:v ?|version )?2 1
3 | 0.95 | lgpl-3.0 | lesser general | (?:gnu )?lesser general public licen[sc]e (?:v ?|version )?3(?: 0)?
3 | 0.85 | lgpl-2.1 | lgpl | (?:gnu )?lgpl ?v? ?2 1
3 | 0.85 | lgpl-3.0 | lgpl | (?:gnu )?lgpl ?v? ?3(?: 0)?
3 | 0.95 | agpl-3.0 | affero | (?:gnu )?affero general public licen[sc]e (?:v ?|version )?3(?: 0)?
3 | 0.85 | agpl-3.0 | agpl | (?:gnu )?agpl ?v? ?3(?: 0)?
3 | 0.95 | gfdl-1.2 | documentation | (?:gnu )?free documentation licen[sc]e (?:v ?|version )?1 2
3 | 0.95 | gfdl-1.3 | documentation | (?:gnu )?free documentation licen[sc]e (?:v ?|version )?1 3
3 | 0.95 | mpl-1.0 | mozilla | mozilla public licen[sc]e (?:v ?|version )?1 0
3 | 0.95 | mpl-1.1 | mozilla | mozilla public licen[sc]e (?:v ?|version )?1 1
3 | 0.95 | mpl-2.0 | mozilla | mozilla public licen[sc]e (?:v ?|version )?2 0
3 | 0.95 | epl-1.0 | eclipse | eclipse public licen[sc]e (?:v ?|version )?1 0
3 | 0.95 | epl-2.0 | eclipse | eclipse public licen[sc]e (?:v ?|version )?2 0
3 | 0.95 | cddl-1.1 | common development | common development and distribution licen[sc]e (?:v ?|version )?1 1
3 | 0.95 | cddl-1.0 | common development | common development and distribution licen[sc]e(?: (?:v ?|version )?1 0)?
3 | 0.95 | cpl-1.0 | common public | common public licen[sc]e(?: (?:v ?|version )?1 0)?
3 | 0.95 | cpal-1.0 | common public attribution | common public attribution licen[sc]e(?: (?:v ?|version )?1 0)?
3 | 0.95 | eupl-1.1 | european union | european union public licen[sc]e (?:v ?|version )?1 1
3 | 0.95 | eupl-1.2 | european union | european union public licen[sc]e(?: (?:v ?|version )?1 2)?
3 | 0.95 | osl-3.0 | open software | open software licen[sc]e(?: (?:v ?|version )?3 0)?
3 | 0.95 | afl-3.0 | academic free | academic free licen[sc]e(?: (?:v ?|version )?3 0)?
3 | 0.95 | artistic-1.0 | artistic | artistic licen[sc]e (?:v ?|version )?1 0
3 | 0.95 | artistic-2.0 | artistic | artistic licen[sc]e (?:v ?|version )?2 0
3 | 0.95 | bsl-1.0 | boost | boost software licen[sc]e(?: (?:v ?|version )?1 0)?
3 | 0.95 | busl-1.1 | business source | business source licen[sc]e(?: (?:v ?|version )?1 1)?
3 | 0.95 | sspl-1.0 | server side | server side public licen[sc]e(?: (?:v ?|version )?1(?: 0)?)?
3 | 0.95 | elastic-2.0 | elastic | elastic licen[sc]e(?: (?:v ?|version )?2(?: 0)?)?
3 | 0.9 | zlib | zlib | zlib(?: libpng)? licen[sc]e
3 | 0.9 | libpng-2.0 | libpng | (?:png reference library|libpng) licen[sc]e(?: (?:v ?|version )?2(?: 0)?)? libpng
3 | 0.85 | libpng | libpng | libpng licen[sc]e
3 | 0.9 | openssl | openssl | openssl(?: ssleay)? licen[sc]e
3 | 0.9 | python-2.0 | python | python software foundation licen[sc]e(?: (?:v ?|version )?2)?
3 | 0.85 | python-2.0 | psf | psf licen[sc]e(?: agreement)?(?: 2)?
3 | 0.85 | ruby | ruby | ruby licen[sc]e
3 | 0.9 | php-3.01 | php | php licen[sc]e (?:v ?|version )?3 01
3 | 0.85 | php | php | php licen[sc]e
3 | 0.9 | postgresql | postgresql | postgresql licen[sc]e
3 | 0.9 | ncsa | illinois | university of illinois(?: ncsa)? open source licen[sc]e
3 | 0.85 | ncsa | ncsa | ncsa(?: open source)? licen[sc]e
3 | 0.95 | wtfpl | do what | do what the \S+ you want to public licen[sc]e
3 | 0.85 | wtfpl | wtfpl | wtfpl licen[sc]e
3 | 0.9 | unlicense | unlicen | unlicen[sc]e
3 | 0.95 | cc0-1.0 | cc0 | (?:creative commons )?cc0(?: 1 0)?(?: universal)?(?: public domain dedication)? licen[sc]e
3 | 0.9 | cc0-1.0 | commons zero | creative commons zero(?: v?1 0)?(?: universal)?
3 | 0.95 | cc-by-2.0 | creative commons | creative commons attribution 2 0(?: generic)?(?: licen[sc]e)?
3 | 0.95 | cc-by-2.5 | creative commons | creative commons attribution 2 5(?: generic)?(?: licen[sc]e)?
3 | 0.95 | cc-by-3.0 | creative commons | creative commons attribution 3 0(?: unported)?(?: licen[sc]e)?
3 | 0.95 | cc-by-4.0 | creative commons | creative commons attribution 4 0(?: international)?(?: licen[sc]e)?
3 | 0.95 | cc-by-sa-2.0 | creative commons | creative commons attribution share ?alike 2 0(?: generic)?(?: licen[sc]e)?
3 | 0.95 | cc-by-sa-3.0 | creative commons | creative commons attribution share ?alike 3 0(?: unported)?(?: licen[sc]e)?
3 | 0.95 | cc-by-sa-4.0 | creative commons | creative commons attribution share ?alike 4 0(?: international)?(?: licen[sc]e)?
3 | 0.95 | cc-by-nc-3.0 | creative commons | creative commons attribution non ?commercial 3 0(?: unported)?(?: licen[sc]e)?
3 | 0.95 | cc-by-nc-4.0 | creative commons | creative commons attribution non ?commercial 4 0(?: international)?(?: licen[sc]e)?
3 | 0.95 | cc-by-nc-sa-4.0 | creative commons | creative commons attribution non ?commercial share ?alike 4 0(?: international)?(?: licen[sc]e)?
3 | 0.95 | cc-by-nc-nd-4.0 | creative commons | creative commons attribution non ?commercial no ?derivatives 4 0(?: international)?(?: licen[sc]e)?
3 | 0.95 | cc-by-nd-4.0 | creative commons | creative commons attribution no ?derivatives 4 0(?: international)?(?: licen[sc]e)?
3 | 0.9 | cc-by-2.0 | cc by 2 0 | licen[sc]ed under (?:a |the )?cc by 2 0
3 | 0.9 | cc-by-3.0 | cc by 3 0 | licen[sc]ed under (?:a |the )?cc by 3 0
3 | 0.9 | cc-by-4.0 | cc by 4 0 | licen[sc]ed under (?:a |the )?cc by 4 0
3 | 0.9 | cc-by-sa-3.0 | cc by sa 3 0 | licen[sc]ed under (?:a |the )?cc by sa 3 0
3 | 0.9 | cc-by-sa-4.0 | cc by sa 4 0 | licen[sc]ed under (?:a |the )?cc by sa 4 0
3 | 0.9 | cc-by-nd-4.0 | cc by nd 4 0 | licen[sc]ed under (?:a |the )?cc by nd 4 0
3 | 0.9 | cc-by-nc-3.0 | cc by nc 3 0 | licen[sc]ed under (?:a |the )?cc by nc 3 0
3 | 0.9 | cc-by-nc-4.0 | cc by nc 4 0 | licen[sc]ed under (?:a |the )?cc by nc 4 0
3 | 0.9 | cc-by-nc-sa-4.0 | cc by nc sa | licen[sc]ed under (?:a |the )?cc by nc sa 4 0
3 | 0.9 | cc-by-nc-nd-4.0 | cc by nc nd | licen[sc]ed under (?:a |the )?cc by nc nd 4 0
3 | 0.85 | cc-by-4.0 | cc by 4 0 | cc by 4 0 licen[sc]e
3 | 0.85 | cc-by-sa-4.0 | cc by sa 4 0 | cc by sa 4 0 licen[sc]e
3 | 0.85 | cc-by-nc-4.0 | cc by nc 4 0 | cc by nc 4 0 licen[sc]e
3 | 0.95 | odbl-1.0 | open database | open (?:data commons open )?database licen[sc]e(?: (?:v ?|version )?1 0)?
3 | 0.95 | odc-by-1.0 | data commons | open data commons attribution licen[sc]e(?: (?:v ?|version )?1 0)?
3 | 0.95 | pddl-1.0 | data commons | open data commons public domain dedication(?: and licen[sc]e)?
3 | 0.95 | cdla-permissive-2.0 | community data | community data licen[sc]e agreement permissive(?: version)?(?: 2 0)?
3 | 0.95 | cdla-sharing-1.0 | community data | community data licen[sc]e agreement sharing(?: version)?(?: 1 0)?
3 | 0.95 | ofl-1.1 | open font | (?:sil )?open font licen[sc]e(?: (?:v ?|version )?1 1)?
3 | 0.9 | openrail | openrail | (?:bigscience |creativeml )?openrail(?: m)? licen[sc]e
3 | 0.9 | openrail | open rail | (?:bigscience |creativeml )?open rail(?: m)? licen[sc]e
3 | 0.95 | upl-1.0 | universal permissive | universal permissive licen[sc]e(?: (?:v ?|version )?1 0)?
3 | 0.95 | ms-pl | microsoft public | microsoft public licen[sc]e
3 | 0.95 | ms-rl | microsoft reciprocal | microsoft reciprocal licen[sc]e
3 | 0.95 | blueoak-1.0.0 | blue oak | blue oak model licen[sc]e(?: 1 0 0)?
3 | 0.95 | cecill-2.1 | cecill | cecill(?: free software)? licen[sc]e(?: agreement)?(?: 2 1)?
3 | 0.95 | cecill-b | cecill b | cecill b(?: free software)? licen[sc]e(?: agreement)?
3 | 0.9 | hpnd | historical | historical permission notice and disclaimer
3 | 0.95 | ogl-uk-3.0 | open government | open government licen[sc]e (?:v ?|version )?3 0
3 | 0.85 | ogl | open government | open government licen[sc]e
3 | 0.9 | etalab-2.0 | etalab | (?:etalab )?open licen[sc]e(?: 2 0)? etalab
3 | 0.9 | dl-de-by-2.0 | datenlizenz | datenlizenz deutschland namensnennung 2 0 .{0,80}licen[sc]e
3 | 0.9 | w3c | w3c | w3c software(?: notice)?(?: and document)? licen[sc]e
3 | 0.85 | vim | vim | vim licen[sc]e
3 | 0.85 | tcl | tcl | tcl(?: tk)? licen[sc]e
3 | 0.85 | json | json | json licen[sc]e
3 | 0.85 | curl | curl | curl licen[sc]e
3 | 0.85 | ijg | jpeg group | independent jpeg group(?: s)? licen[sc]e
3 | 0.85 | freetype | freetype | freetype (?:project )?licen[sc]e
3 | 0.85 | imagemagick | imagemagick | imagemagick licen[sc]e
3 | 0.85 | sleepycat | sleepycat | sleepycat (?:public )?licen[sc]e
3 | 0.85 | watcom-1.0 | watcom | (?:sybase )?open watcom public licen[sc]e(?: (?:v ?|version )?1 0)?
3 | 0.85 | apsl-2.0 | apple public | apple public source licen[sc]e(?: (?:v ?|version )?2(?: 0)?)?
3 | 0.85 | ipl-1.0 | ibm public | ibm public licen[sc]e(?: (?:v ?|version )?1 0)?
3 | 0.85 | nposl-3.0 | non profit open | non profit open software licen[sc]e(?: (?:v ?|version )?3 0)?
3 | 0.85 | qpl-1.0 | q public | q public licen[sc]e(?: (?:v ?|version )?1 0)?
3 | 0.85 | rpl-1.5 | reciprocal public | reciprocal public licen[sc]e(?: (?:v ?|version )?1 5)?
3 | 0.85 | spl-1.0 | sun public | sun public licen[sc]e(?: (?:v ?|version )?1 0)?
3 | 0.85 | mulanpsl-2.0 | mulan | mulan (?:psl|permissive software licen[sc]e)(?: v2)? licen[sc]e
3 | 0.85 | llama | llama | llama(?: [23])?(?: 1)? community licen[sc]e(?: agreement)?
3 | 0.85 | polyform | polyform | polyform (?:noncommercial|small business|shield|strict|free trial) licen[sc]e(?: 1 0 0)?
3 | 0.85 | commons-clause | commons clause | commons clause(?: licen[sc]e condition)?(?: v1 0)?
3 | 0.85 | hippocratic | hippocratic | hippocratic licen[sc]e(?: (?:v ?|version )?[23] [01])?
# 4: names of families
4 | 0.8 | mit | mit licen | mit licen[sc]es?
4 | 0.85 | mit | under | (?:licen[sc]ed|released|distributed|available|provided) under (?:the )?(?:terms of the )?mit licen[sc]e
4 | 0.8 | isc | isc licen | isc licen[sc]e
4 | 0.7 | bsd | bsd | bsd(?: style)? licen[sc]es?
4 | 0.75 | apache | apache licen | apache(?: software)? licen[sc]es?
4 | 0.75 | gpl | general public | (?:gnu )?general public licen[sc]es?
4 | 0.75 | lgpl | lesser general | (?:gnu )?lesser general public licen[sc]e
4 | 0.75 | agpl | affero | (?:gnu )?affero general public licen[sc]e
4 | 0.6 | gpl | gpl | gnu gpl
4 | 0.6 | gpl | gpl licen | gpl licen[sc]ed?
4 | 0.6 | lgpl | lgpl licen | lgpl licen[sc]ed?
4 | 0.6 | agpl | agpl licen | agpl licen[sc]ed?
4 | 0.75 | gfdl | documentation | (?:gnu )?free documentation licen[sc]e
4 | 0.75 | mpl | mozilla | mozilla public licen[sc]e
4 | 0.75 | epl | eclipse | eclipse public licen[sc]e
4 | 0.75 | edl-1.0 | eclipse | eclipse distribution licen[sc]e(?: v ?1 0)?
4 | 0.7 | artistic | artistic | (?:perl )?artistic licen[sc]e
4 | 0.7 | cc-by-sa | creative commons | creative commons attribution share ?alike(?: licen[sc]e)?
4 | 0.7 | cc-by-nc-sa | creative commons | creative commons attribution non ?commercial share ?alike(?: licen[sc]e)?
4 | 0.7 | cc-by-nc | creative commons | creative commons attribution non ?commercial(?: licen[sc]e)?
4 | 0.7 | cc-by-nd | creative commons | creative commons attribution no ?derivatives(?: licen[sc]e)?
4 | 0.7 | cc-by | creative commons | creative commons attribution(?: licen[sc]e)?
4 | 0.6 | cc | creative commons | creative commons(?: licen[sc]es?)?
# 5: notices that name no license
5 | 0.6 | all-rights-reserved | rights reserved | all rights reserved
5 | 0.5 | some-rights-reserved | rights reserved | some rights reserved
5 | 0.4 | copyright | copyright | copyright (?:c )?(?:by )?(?:19|20)\d\d(?: (?:19|20)\d\d)?
5 | 0.7 | public-domain | public domain | (?:released |dedicated |placed )?(?:in ?to |to |in )?the public domain
5 | 0.6 | proprietary | proprietary | proprietary (?:and confidential|licen[sc]e|software licen[sc]e|rights)
5 | 0.6 | proprietary | confidential | confidential and proprietary(?: information)?
5 | 0.6 | eula | end user | end user licen[sc]e agreement
5 | 0.6 | commercial | commercial licen | commercial licen[sc]e(?: agreement| required)?
5 | 0.5 | dual-license | dual licen | dual licen[sc](?:e|ed|ing)(?: under)?
5 | 0.5 | multi-license | licenses | (?:under|of) the following licenses
5 | 0.4 | warranty-disclaimer | without warranty | without warranty of any kind(?: express or implied)?
5 | 0.4 | warranty-disclaimer | warrant | provided as is without (?:any )?warrant(?:y|ies)(?: of any kind)?
5 | 0.4 | warranty-disclaimer | merchantability | (?:implied )?warrant(?:y|ies) of merchantability(?: or fitness for a particular purpose| and fitness for a particular purpose)?
5 | 0.3 | copyleft | copyleft | (?:strong |weak )?copyleft
5 | 0.5 | no-redistribution | redistribut | (?:may not be|no) redistribut(?:ed|ion)(?: without permission)?
5 | 0.5 | non-commercial | commercial | (?:for )?non ?commercial use only .{0,60}(?:licen[sc]e|permission|rights)
5 | 0.5 | permission-required | permission | without (?:the )?(?:express |prior )?written permission of
"""


@dataclass(frozen=True)
class Rule:
    priority: int
    confidence: float
    label: str
    keyword: str
    pattern: str


def rules() -> list[Rule]:
    """The rules, in order."""
    lines = [[x.strip() for x in line.split("|", 4)] for line in RULES.strip().splitlines() if not line.startswith("#")]
    return [Rule(int(p), float(c), label, keyword, pattern) for p, c, label, keyword, pattern in lines]


PRIORITIES = 5


def _lit(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _bounded(pattern: str) -> str:
    """The pattern between two spaces of the line."""
    return f"(?<= )(?:{pattern})(?= )"


def _table(found: list[Rule]) -> str:
    """The rules as a constant array, by rank."""
    return "array(" + ",".join(f"named_struct('rank',{i},'priority',{r.priority},'label',{_lit(r.label)},'pattern',{_lit(_bounded(r.pattern))},'confidence',{r.confidence}D)" for i, r in enumerate(found)) + ")"


def _matching(found: list[Rule], line: str) -> str:
    """Ranks of the rules that match, tried only where their keyword stands."""
    by: dict[str, list[str]] = {}
    for i, r in enumerate(found):
        by.setdefault(r.keyword, []).append(f"if({line} rlike {_lit(_bounded(r.pattern))}, {i}, null)")
    return "array_compact(flatten(array(" + ",".join(f"if(contains({line}, {_lit(k)}), array({','.join(v)}), cast(array() as array<int>))" for k, v in by.items()) + ")))"


_SPACES = "(length({0}) - length(replace({0}, ' ', '')))"


KIND = "array<struct<start:int,less:int,rank:int,priority:int,label:string,confidence:double>>"


def _places(found: list[Rule], ranks: str, line: str) -> Column:
    """Detections (start, less, rank, priority, label, confidence) of the rules of given ranks in a
    line of words with a space at both ends.

    less: minus the end, so that of equal starts the longest sorts first.
    """
    one = f"""
      transform(
        slice(aggregate(zip_with(slice(split({line}, r.pattern), 1, size(h.hits)), h.hits, (p, q) -> named_struct('parts', p, 'hits', q)),
          named_struct('at', -1, 'out', cast(array() as array<struct<start:int,less:int>>)),
          (a, x) -> named_struct(
            'at', a.at + {_SPACES.format("x.parts")} + {_SPACES.format("x.hits")},
            'out', array_append(a.out, named_struct('start', a.at + {_SPACES.format("x.parts")}, 'less', -(a.at + {_SPACES.format("x.parts")} + {_SPACES.format("x.hits")} + 1))))
        ).out, 1, size(h.hits)),
        p -> named_struct('start', p.start, 'less', p.less, 'rank', r.rank, 'priority', r.priority, 'label', r.label, 'confidence', r.confidence))"""
    return F.expr(f"""
      flatten(transform(transform({ranks}, i -> element_at({_table(found)}, i + 1)), r ->
        flatten(transform(array(named_struct('hits', regexp_extract_all({line}, r.pattern, 0))), h -> {one}))))""")


def scan(df: DataFrame, text: str = "text", found: list[Rule] | None = None) -> DataFrame:
    """df with ``n_words``, ``base`` and ``detections`` (start, end, label, confidence).

    base: the places of base phrases; detections: those left after suppression.
    """
    source = F.coalesce(quoted(text).cast("string"), F.lit(""))
    lower = F.lower(source)
    gate = F.lit(False)
    for root in ROOTS:
        gate = gate | F.contains(lower, F.lit(root))
    upper = "".join(map(chr, range(65, 91)))
    line = F.concat(F.lit(" "), F.trim(F.regexp_replace(F.translate(source, upper, upper.lower()), GAP, " ")), F.lit(" "))
    base = [Rule(1, 1.0, label, phrase, phrase) for phrase, label in BASE]
    own, name = found or rules(), "__license_line"
    none = F.expr(f"cast(array() as {KIND})")
    a = df.withColumns({"n_words": F.regexp_count(source, F.lit(WORD)).cast("long"), name: F.when(gate, line)})
    some = F.col(name).isNotNull()
    no_rank = F.expr("cast(array() as array<int>)")
    b = a.withColumns({"__license_base": F.when(some, F.expr(_matching(base, name))).otherwise(no_rank), "__license_rules": F.when(some, F.expr(_matching(own, name))).otherwise(no_rank)})
    c = b.withColumns({"base": F.when(F.size("__license_base") > 0, _places(base, "__license_base", name)).otherwise(none), "detections": F.when(F.size("__license_rules") > 0, F.array_sort(_places(own, "__license_rules", name))).otherwise(none)})
    # The furthest end so far of each priority; starts ascend, so an end at or beyond contains.
    kept = F.expr(f"""
      aggregate(detections, named_struct('reach', array_repeat(-1, {PRIORITIES}), 'out', cast(array() as {KIND})),
        (a, x) -> named_struct(
          'reach', transform(a.reach, (e, p) -> if(p + 1 = x.priority, greatest(e, -x.less), e)),
          'out', if(exists(slice(a.reach, 1, x.priority), e -> e >= -x.less), a.out, array_append(a.out, x)))).out""")
    shape = lambda x: F.struct(x["start"].alias("start"), (-x["less"]).alias("end"), x["label"].alias("label"), x["confidence"].alias("confidence"))
    return c.withColumns({"base": F.transform("base", shape), "detections": F.transform(kept, shape)}).drop(name, "__license_base", "__license_rules")


def digests(df: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    s = scan(df.select("doc_id", "text"))
    joined = lambda x: F.array_join(F.array_sort(F.array_distinct(x)), ",")
    return s.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min("base.start").cast("long").alias("first_word"),
        F.array_max("base.start").cast("long").alias("last_word"),
        joined(F.col("base.label")).alias("base_labels"),
        joined(F.concat("base.label", "detections.label")).alias("labels"),
        F.coalesce(F.array_max("detections.confidence"), F.lit(0.0)).alias("score"),
    )
