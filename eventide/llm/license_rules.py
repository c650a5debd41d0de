"""The signature rules of the license scan, in order of preference.

A rule is (label, tier, keyword, expression).  Tier 1 is the wording of a
license or of its grant, tier 2 a notice, tag or link that puts a text under
one, tier 3 a name.  Expressions run over words: a space stands for the step
from one word to the next, ``~`` for any one word; they begin and end at whole
words.  The keyword is a part of a word that every match of the rule holds.
Earlier rules win ties, so special names stand before general ones.
"""

from __future__ import annotations

#: Strength of a detection by its rule's tier, the base phrases' last.
STRENGTH = {1: 1.0, 2: 0.8, 3: 0.5, 4: 0.4}

_GRANT = "(licensed|released|distributed|available|published|provided|covered)( ~)? under( ~)?( terms of)?( the)?"

#: label, keyword, words of its name in one expression, SPDX identifiers as words.
_NAMED = [
    ("agpl-3.0", "affero", "gnu affero general public license( as published by the free software foundation)?( either)?( version)?( v)? ?3( 0)?", "agpl 3 0( only| or later)?"),
    ("agpl", "affero", "(gnu )?affero general public licen[cs]e", "agpl 1 0( only| or later)?"),
    ("lgpl-2.1", "general", "(gnu )?(lesser|library) general public licen[cs]e( either)?( version)? (v2|2) 1", "lgpl 2 1( only| or later)?"),
    ("lgpl-3.0", "lesser", "(gnu )?lesser general public licen[cs]e( either)?( version)? v?3( 0)?", "lgpl 3 0( only| or later)?"),
    ("lgpl", "general", "(gnu )?(lesser|library) general public licen[cs]e", "lgpl 2 0( only| or later)?"),
    ("gpl-2.0", "general", "(gnu )?general public licen[cs]e( as published by the free software foundation)?( either)?( version)? v?2( 0)?", "gpl 2 0( only| or later)?"),
    ("gpl-3.0", "general", "(gnu )?general public licen[cs]e( as published by the free software foundation)?( either)?( version)? v?3( 0)?", "gpl 3 0( only| or later)?"),
    ("gpl-1.0", "general", "(gnu )?general public licen[cs]e( version)? v?1( 0)?", "gpl 1 0( only| or later)?"),
    ("gfdl", "documentation", "(gnu )?free documentation licen[cs]e( version 1 [123])?", "gfdl 1 [123]( only| or later)?"),
    ("apache-2.0", "apache", "apache( software)? licen[cs]e( version)? (v2|2)( 0)?", "apache 2 0"),
    ("apache-1.1", "apache", "apache( software)? licen[cs]e( version)? 1 1", "apache 1 1"),
    ("apache-1.0", "apache", "apache( software)? licen[cs]e( version)? 1 0", "apache 1 0"),
    ("mit-0", "mit", "mit no attribution licen[cs]e", "mit 0"),
    ("mit", "mit", "mit( style| x11)? licen[cs]e", "mit"),
    ("x11", "x11", "x11 licen[cs]e", "x11"),
    ("bsd-4-clause", "bsd", "(4|four) clause bsd licen[cs]e", "bsd 4 clause( uc)?"),
    ("bsd-3-clause", "bsd", "(3|three) clause bsd licen[cs]e", "bsd 3 clause( clear)?"),
    ("bsd-2-clause", "bsd", "(2|two) clause bsd licen[cs]e", "bsd 2 clause( patent| views)?"),
    ("0bsd", "bsd", "(0|zero) clause bsd( licen[cs]e)?", "0bsd"),
    ("bsd", "bsd", "bsd( style)? licen[cs]e", "bsd 1 clause"),
    ("mpl-2.0", "mozilla", "mozilla public licen[cs]e( v| version)? ?2( 0)?", "mpl 2 0( no copyleft exception)?"),
    ("mpl-1.1", "mozilla", "mozilla public licen[cs]e( v| version)? ?1 1", "mpl 1 1"),
    ("mpl", "mozilla", "mozilla public licen[cs]e", "mpl 1 0"),
    ("epl-2.0", "eclipse", "eclipse public licen[cs]e( v| version)? ?2( 0)?", "epl 2 0"),
    ("epl-1.0", "eclipse", "eclipse public licen[cs]e( v| version)? ?1( 0)?", "epl 1 0"),
    ("edl", "eclipse", "eclipse distribution licen[cs]e", "edl 1 0"),
    ("cddl", "distribution", "common development and distribution licen[cs]e( version 1 [01])?", "cddl 1 [01]"),
    ("cpl-1.0", "common", "common public licen[cs]e( version 1 0)?", "cpl 1 0"),
    ("ipl-1.0", "ibm", "ibm public licen[cs]e( version 1 0)?", "ipl 1 0"),
    ("eupl", "european", "european union public licen[cs]e( v| version)?( 1 [12])?", "eupl 1 [12]"),
    ("cecill", "cecill", "cecill( [abc])?( free software)?( licen[cs]e)?", "cecill 2 [01]"),
    ("artistic-2.0", "artistic", "artistic licen[cs]e 2( 0)?", "artistic 2 0"),
    ("artistic-1.0", "artistic", "(clarified )?artistic licen[cs]e", "artistic 1 0( perl| cl8)?"),
    ("isc", "isc", "isc licen[cs]e", "isc"),
    ("zlib", "zlib", "zlib( libpng)? licen[cs]e", "zlib"),
    ("libpng", "libpng", "libpng licen[cs]e", "libpng( 2 0)?"),
    ("bsl-1.0", "boost", "boost software licen[cs]e( version 1 0)?", "bsl 1 0"),
    ("busl-1.1", "business", "business source licen[cs]e( 1 1)?", "busl 1 1"),
    ("sspl-1.0", "server", "server side public licen[cs]e( version 1)?", "sspl 1 0"),
    ("elastic-2.0", "elastic", "elastic licen[cs]e( 2 0)?", "elastic 2 0"),
    ("wtfpl", "public", "do what the ~ you want to public licen[cs]e", "wtfpl"),
    ("unlicense", "unlicense", "the unlicense", "unlicense"),
    ("openssl", "openssl", "openssl licen[cs]e", "openssl"),
    ("php-3.01", "php", "php licen[cs]e( version 3 0?1)?", "php 3 0?1"),
    ("psf-2.0", "python", "python software foundation licen[cs]e( version 2)?", "psf 2 0"),
    ("python-2.0", "python", "python licen[cs]e", "python 2 0( 1)?"),
    ("ruby", "ruby", "ruby licen[cs]e", "ruby"),
    ("perl", "perl", "same terms as perl itself", "artistic 1 0 perl or gpl 1 0 or later"),
    ("postgresql", "postgresql", "postgresql licen[cs]e", "postgresql"),
    ("ofl-1.1", "sil", "sil open font licen[cs]e( version 1 [01])?", "ofl 1 [01]( rfn| no rfn)?"),
    ("ncsa", "ncsa", "university of illinois ncsa open source licen[cs]e", "ncsa"),
    ("ecl-2.0", "educational", "educational community licen[cs]e( version 2 0)?", "ecl 2 0"),
    ("afl-3.0", "academic", "academic free licen[cs]e( version)?( 3 0)?", "afl 3 0"),
    ("osl-3.0", "open", "open software licen[cs]e( version)?( 3 0)?", "osl 3 0"),
    ("ms-pl", "microsoft", "microsoft public licen[cs]e", "ms pl"),
    ("ms-rl", "microsoft", "microsoft reciprocal licen[cs]e", "ms rl"),
    ("upl-1.0", "universal", "universal permissive licen[cs]e( version 1 0)?", "upl 1 0"),
    ("w3c", "w3c", "w3c software( notice and)?( document)? licen[cs]e", "w3c"),
    ("zpl-2.1", "zope", "zope public licen[cs]e( version 2 1)?", "zpl 2 1"),
    ("sleepycat", "sleepycat", "sleepycat licen[cs]e", "sleepycat"),
    ("curl", "curl", "curl licen[cs]e", "curl"),
    ("vim", "vim", "vim licen[cs]e", "vim"),
    ("beerware", "beer", "beer ?ware licen[cs]e", "beerware"),
    ("json", "json", "json licen[cs]e", "json"),
    ("hpnd", "historical", "historical permission notice and disclaimer", "hpnd"),
    ("ntp", "ntp", "ntp licen[cs]e", "ntp"),
    ("odbl-1.0", "database", "open( data commons)?( open)? database licen[cs]e( v1 0)?", "odbl 1 0"),
    ("odc-by-1.0", "attribution", "open data commons attribution licen[cs]e( v1 0)?", "odc by 1 0"),
    ("pddl-1.0", "domain", "public domain dedication and licen[cs]e", "pddl 1 0"),
    ("mulan-psl-2.0", "mulan", "mulan permissive software licen[cs]e( v(ersion )?2)?", "mulanpsl 2 0"),
    ("rpl-1.5", "reciprocal", "reciprocal public licen[cs]e( 1 5)?", "rpl 1 5"),
    ("qpl-1.0", "public", "q public licen[cs]e( version 1 0)?", "qpl 1 0"),
    ("npl-1.1", "netscape", "netscape public licen[cs]e( version 1 1)?", "npl 1 1"),
    ("spl-1.0", "sun", "sun public licen[cs]e( version 1 0)?", "spl 1 0"),
    ("rail", "responsible", "responsible ai licen[cs]e", "openrail( m)?"),
    ("llama", "llama", "llama( [23])? community licen[cs]e( agreement)?", "llama[23]"),
]

#: Creative Commons: label, words of the long name, words of the short one.
_COMMONS = [
    ("cc-by-nc-nd", "attribution non ?commercial no ?deriv(ative)?s", "by nc nd"),
    ("cc-by-nc-sa", "attribution non ?commercial share ?alike", "by nc sa"),
    ("cc-by-nd", "attribution no ?deriv(ative)?s", "by nd"),
    ("cc-by-nc", "attribution non ?commercial", "by nc"),
    ("cc-by-sa", "attribution share ?alike", "by sa"),
    ("cc-by", "attribution", "by"),
]

#: Wordings: label, tier, keyword, expression.
_WORDINGS = [
    ("mit", 1, "permission", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit", 1, "copies", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("mit", 1, "warranty", "the software is provided as is without warranty of any kind express or implied"),
    ("isc", 1, "permission", "permission to use copy modify and( or)? distribute this software for any purpose with or without fee is hereby granted"),
    ("bsd", 1, "redistribution", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd", 1, "redistributions", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd", 1, "redistributions", "redistributions in binary form must reproduce the above copyright notice this list of conditions"),
    ("bsd-3-clause", 1, "endorse", "may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("bsd-4-clause", 1, "advertising", "all advertising materials mentioning features or use of this software must display the following acknowledg(e)?ment"),
    ("apache-2.0", 1, "apache", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"),
    ("apache-2.0", 1, "license", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis"),
    ("gpl", 1, "redistribute", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("lgpl", 1, "redistribute", "you can redistribute it and or modify it under the terms of the gnu (lesser|library) general public license as published by the free software foundation"),
    ("agpl", 1, "redistribute", "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation"),
    ("gpl", 1, "merchantability", "without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public license"),
    ("gpl", 1, "verbatim", "everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed"),
    ("gfdl", 1, "document", "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license"),
    ("mpl-2.0", 1, "mozilla", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("mpl-1.1", 1, "mozilla", "the contents of this file are subject to the mozilla public license version 1 1"),
    ("epl-1.0", 1, "eclipse", "this program and the accompanying materials are made available under the terms of the eclipse public license v1 0"),
    ("epl-2.0", 1, "eclipse", "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0"),
    ("cddl", 1, "distribution", "the contents of this file are subject to the terms of the common development and distribution license"),
    ("zlib", 1, "damages", "in no event will the authors be held liable for any damages arising from the use of this software"),
    ("zlib", 1, "misrepresented", "the origin of this software must not be misrepresented you must not claim that you wrote the original software"),
    ("bsl-1.0", 1, "boost", "distributed under the boost software license version 1 0"),
    ("unlicense", 1, "unencumbered", "this is free and unencumbered software released into the public domain"),
    ("unlicense", 1, "anyone", "anyone is free to copy modify publish use compile sell or distribute this software"),
    ("wtfpl", 1, "want", "you just do what the ~ you want to"),
    ("beerware", 1, "retain", "as long as you retain this notice you can do whatever you want with this stuff"),
    ("json", 1, "software", "the software shall be used for good not evil"),
    ("ofl-1.1", 1, "font", "this font software is licensed under the sil open font license version 1 1"),
    ("postgresql", 1, "permission", "permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted"),
    ("hpnd", 1, "permission", "permission to use copy modify and distribute this software and its documentation for any purpose and without fee is hereby granted"),
    ("openssl", 1, "openssl", "this product includes software developed by the openssl project"),
    ("curl", 1, "permission", "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice"),
    ("artistic-2.0", 1, "artistic", "you may distribute under the terms of either the gnu general public license or the artistic license"),
    ("perl", 2, "perl", "you can redistribute it and or modify it under the same terms as perl itself"),
    ("cc0-1.0", 1, "dedicated", "has dedicated the work to the public domain by waiving all of his or her rights"),
    ("cc0-1.0", 2, "cc0", "cc0( 1 0)?( universal)?( licen[cs]e| public domain dedication)?"),
    ("cc0-1.0", 2, "publicdomain", "creativecommons org publicdomain zero 1 0"),
    ("cc-pdm", 2, "publicdomain", "creativecommons org publicdomain mark 1 0"),
    ("public-domain", 2, "domain", "(released|dedicated|placed|put)( ~)? (in|into|to) the public domain"),
    ("public-domain", 3, "domain", "(is|are) in the public domain"),
    ("public-domain", 3, "domain", "public domain (work|software|code|image|text|dedication)"),
    ("proprietary", 1, "proprietary", "proprietary and confidential"),
    ("proprietary", 1, "unauthorized", "unauthorized copying( of this file)?( via any medium)? is strictly prohibited"),
    ("proprietary", 2, "reserved", "all rights( are)? reserved"),
    ("proprietary", 2, "reproduced", "no part of this (publication|work|document|book) may be reproduced( or transmitted)?"),
    ("proprietary", 2, "permission", "without( the)?( express| prior)?( express| prior)? written permission of the (publisher|author|owner|copyright holder)"),
    ("proprietary", 2, "trade", "contains trade secrets"),
    ("proprietary", 3, "agreement", "end user licen[cs]e agreement"),
    ("proprietary", 3, "eula", "eula"),
    ("commercial", 2, "commercial", "commercial licen[cs]e( agreement)?"),
    ("commercial", 2, "purchase", "requires( the)? purchase of a licen[cs]e"),
    ("evaluation", 2, "evaluation", "for evaluation( purposes)? only"),
    ("non-commercial", 2, "commercial", "(for )?non ?commercial (use|purposes)( only)?"),
    ("research-only", 2, "research", "for( academic| non ?commercial)? research( purposes| use)? only"),
    ("educational-only", 2, "educational", "for educational (use|purposes) only"),
    ("personal-only", 2, "personal", "for personal use only"),
    ("apache-2.0", 2, "apache", "apache org licenses licen[cs]e 2 0"),
    ("mit", 2, "opensource", "opensource org licenses mit( license)?"),
    ("bsd-3-clause", 2, "opensource", "opensource org licenses bsd 3 clause"),
    ("bsd-2-clause", 2, "opensource", "opensource org licenses bsd 2 clause"),
    ("isc", 2, "opensource", "opensource org licenses isc"),
    ("gpl-3.0", 2, "gnu", "gnu org licenses gpl 3 0"),
    ("gpl-2.0", 2, "gnu", "gnu org licenses (old licenses )?gpl 2 0"),
    ("lgpl-3.0", 2, "gnu", "gnu org licenses lgpl 3 0"),
    ("lgpl-2.1", 2, "gnu", "gnu org licenses (old licenses )?lgpl 2 1"),
    ("agpl-3.0", 2, "gnu", "gnu org licenses agpl 3 0"),
    ("gpl", 2, "gnu", "gnu org licenses( gpl)?"),
    ("mpl-2.0", 2, "mozilla", "mozilla org mpl 2 0"),
    ("mpl-1.1", 2, "mozilla", "mozilla org mpl 1 1"),
    ("epl-2.0", 2, "eclipse", "eclipse org legal epl (2 0|v20)"),
    ("epl-1.0", 2, "eclipse", "eclipse org legal epl v10"),
    ("bsl-1.0", 2, "boost", "boost org license 1 0 txt"),
    ("unlicense", 2, "unlicense", "unlicense org"),
    ("wtfpl", 2, "wtfpl", "wtfpl net"),
    ("ofl-1.1", 2, "sil", "scripts sil org ofl"),
    ("odbl-1.0", 2, "opendatacommons", "opendatacommons org licenses odbl( 1 0)?"),
    ("odc-by-1.0", 2, "opendatacommons", "opendatacommons org licenses by( 1 0)?"),
    ("pddl-1.0", 2, "opendatacommons", "opendatacommons org licenses pddl( 1 0)?"),
    ("cc-by", 2, "attribution", "some rights reserved attribution required"),
    ("permissive", 3, "permissive", "permissive( open source)? licen[cs]e"),
    ("copyleft", 3, "copyleft", "copyleft( licen[cs]e)?"),
    ("open-source", 3, "open", "open source( software)? licen[cs]e"),
    ("dual", 2, "dual", "dual licen[cs]ed( under)?"),
    ("gpl-with-exception", 2, "classpath", "general public licen[cs]e( version)?( 2)? with( the)? classpath exception"),
    ("gpl-with-exception", 2, "runtime", "gcc runtime library exception"),
    ("gpl-with-exception", 2, "exception", "(autoconf|bison|font|linux syscall note) exception"),
    ("commons-clause", 2, "commons", "commons clause( licen[cs]e condition)?"),
    ("ethical", 2, "hippocratic", "hippocratic licen[cs]e( version)?( 2 1)?"),
    ("fair", 2, "fair", "fair( source)? licen[cs]e"),
    ("cc-sampling", 2, "sampling", "creative commons sampling( plus)?( 1 0)?"),
]


def rules() -> list[tuple[str, int, str, str]]:
    """(label, tier, keyword, expression) in order of preference."""
    out = [r for r in _WORDINGS if r[1] == 1]
    for label, name, short in _COMMONS:
        version = "( international| unported| generic| intl)?( [1234] 0)?( international| unported| generic)?"
        out += [(label, 2, "commons", f"{_GRANT}( a)? creative commons {name}{version}( licen[cs]e)?"),
                (label, 2, "cc", f"{_GRANT}( a)? cc {short}( [1234] 0)?( licen[cs]e)?"),
                (label, 2, "creativecommons", f"creativecommons org licenses {short}( [1234] 0)?"),
                (label, 2, "spdx", f"spdx license identifier cc {short} [1234] 0"),
                (label, 3, "commons", f"creative commons {name}{version}( licen[cs]e)?"),
                (label, 3, "cc", f"cc {short} [1234] 0( licen[cs]e)?")]
    for label, keyword, name, spdx in _NAMED:
        out += [(label, 2, keyword, f"{_GRANT} {name}"),
                (label, 2, "spdx", f"spdx license identifier {spdx}"),
                (label, 2, "license", f"license( s)? {spdx}"),
                (label, 3, keyword, name)]
    return out + [r for r in _WORDINGS if r[1] > 1]
