"""Hand-written licence signatures: regexes over the words of a text (lower case, single spaces between), most telling first.

Each level is (name, confidence, signatures); a signature is (label, keyword, regex). The keyword is in every match.
"""

from __future__ import annotations

#: Passages that stand in one licence only.
TEXTS = (
    ("mit", "permission is hereby granted free of charge", r"permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("mit", "to deal in the software without restriction", r"to deal in the software without restriction including without limitation the rights to use copy modify merge publish"),
    ("mit", "shall be included in all copies or substantial portions", r"the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("mit-0", "to whom the software is furnished to do so the software", r"to permit persons to whom the software is furnished to do so the software is provided as is"),
    ("x11", "except as contained in this notice", r"except as contained in this notice the names? of .{1,80}? shall not be used in advertising"),
    ("isc", "permission to use copy modify and or distribute this software", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("0bsd", "with or without fee is hereby granted the software", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software"),
    ("bsd", "redistribution and use in source and binary forms", r"redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd", "redistributions of source code must retain", r"redistributions of source code must retain the above copyright notice this list of conditions"),
    ("bsd", "redistributions in binary form must reproduce", r"redistributions in binary form must reproduce the above copyright notice"),
    ("bsd-3-clause", "may be used to endorse or promote products", r"neither the names? of .{1,120}? may be used to endorse or promote products derived from this software"),
    ("bsd-4-clause", "advertising materials mentioning features", r"all advertising materials mentioning features or use of this software must display"),
    ("bsd-3-clause-clear", "express or implied licenses to any party", r"no express or implied licen[cs]es to any party s patent rights are granted"),
    ("zlib", "altered source versions must be plainly marked", r"altered source versions must be plainly marked as such"),
    ("zlib", "the origin of this software must not be misrepresented", r"the origin of this software must not be misrepresented"),
    ("zlib", "provided as is without any express or implied warranty", r"this software is provided as is without any express or implied warranty"),
    ("apache-2.0", "unless required by applicable law or agreed to in writing software", r"unless required by applicable law or agreed to in writing software distributed under the licen[cs]e is distributed on an as is basis"),
    ("apache-2.0", "may not use this file except in compliance", r"you may not use this file except in compliance with the licen[cs]e"),
    ("apache-2.0", "grant of patent license subject to the terms", r"grant of patent licen[cs]e subject to the terms and conditions of this licen[cs]e each contributor"),
    ("apache-1.1", "this product includes software developed by the apache", r"this product includes software developed by the apache (?:software foundation|group)"),
    ("gpl", "you can redistribute it and or modify it under the terms of the gnu", r"you can redistribute it and or modify it under the terms of the gnu general public licen[cs]e"),
    ("gpl-2.0-or-later", "either version 2 of the license or", r"gnu general public licen[cs]e as published by the free software foundation either version 2 of the licen[cs]e or (?:at your option )?any later version"),
    ("gpl-3.0-or-later", "either version 3 of the license or", r"gnu general public licen[cs]e as published by the free software foundation either version 3 of the licen[cs]e or (?:at your option )?any later version"),
    ("gpl-2.0-only", "version 2 of the license", r"gnu general public licen[cs]e (?:as published by the free software foundation )?version 2 of the licen[cs]e(?! or)"),
    ("lgpl-2.1-or-later", "either version 2 1 of the license or", r"gnu lesser general public licen[cs]e as published by the free software foundation either version 2 1 of the licen[cs]e or"),
    ("lgpl-2.0-or-later", "gnu library general public license as published", r"gnu library general public licen[cs]e as published by the free software foundation either version 2 of the licen[cs]e or"),
    ("lgpl-3.0-or-later", "gnu lesser general public license as published", r"gnu lesser general public licen[cs]e as published by the free software foundation either version 3 of the licen[cs]e or"),
    ("agpl-3.0-or-later", "gnu affero general public license as published", r"gnu affero general public licen[cs]e as published by the free software foundation either version 3"),
    ("gpl", "but without any warranty without even the implied warranty", r"but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose see the gnu"),
    ("gpl", "you should have received a copy of the gnu", r"you should have received a copy of the gnu (?:lesser |library |affero )?general public licen[cs]e"),
    ("gpl", "everyone is permitted to copy and distribute verbatim", r"everyone is permitted to copy and distribute verbatim copies of this licen[cs]e document"),
    ("gpl-classpath-exception", "as a special exception the copyright holders of this library", r"as a special exception the copyright holders of this library give you permission to link"),
    ("gfdl", "permission is granted to copy distribute and or modify this document", r"permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation licen[cs]e"),
    ("gfdl", "with no invariant sections", r"with no invariant sections no front cover texts and no back cover texts"),
    ("mpl-1.1", "the contents of this file are subject to the mozilla public license", r"the contents of this file are subject to the mozilla public licen[cs]e version 1 1"),
    ("mpl-1.0", "subject to the mozilla public license version 1 0", r"subject to the mozilla public licen[cs]e version 1 0"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla", r"this source code form is subject to the terms of the mozilla public licen[cs]e v 2 0"),
    ("epl-1.0", "made available under the terms of the eclipse public license", r"made available under the terms of the eclipse public licen[cs]e v ?1 0"),
    ("epl-2.0", "made available under the terms of the eclipse public license", r"made available under the terms of the eclipse public licen[cs]e (?:v ?)?2 0"),
    ("cpl-1.0", "common public license v1 0", r"under the terms of the common public licen[cs]e v1 0"),
    ("cddl-1.0", "subject to the terms of the common development and distribution", r"subject to the terms of the common development and distribution licen[cs]e"),
    ("eupl", "licensed under the eupl", r"licensed under the eupl version 1 [012]"),
    ("artistic", "redistribute it and or modify it under the same terms as perl", r"you (?:may|can) redistribute it and or modify it under the same terms as perl itself"),
    ("artistic", "the intent of this document is to state the conditions", r"the intent of this document is to state the conditions under which a package may be copied"),
    ("boost-1.0", "boost software license version 1 0 august", r"boost software licen[cs]e version 1 0 august 17th 2003"),
    ("boost-1.0", "solely in the form of machine executable object code", r"solely in the form of machine executable object code generated by a source language processor"),
    ("unlicense", "this is free and unencumbered software", r"this is free and unencumbered software released into the public domain"),
    ("unlicense", "in jurisdictions that recognize copyright laws", r"in jurisdictions that recognize copyright laws the author or authors of this software dedicate"),
    ("cc0-1.0", "has waived all copyright", r"has waived all copyright and related or neighbou?ring rights"),
    ("cc0-1.0", "to the extent possible under law", r"to the extent possible under law the (?:person|author)s? .{0,60}?waived all copyright"),
    ("ofl-1.1", "the font software is provided as is", r"the font software is provided as is without warranty of any kind"),
    ("ofl-1.1", "reserved font name", r"with reserved font names?"),
    ("psf-2.0", "python software foundation license version 2", r"python software foundation licen[cs]e version 2"),
    ("openssl", "this product includes software developed by the openssl project", r"this product includes software developed by the openssl project for use in the openssl toolkit"),
    ("openssl", "this product includes cryptographic software written by", r"this product includes cryptographic software written by [a-z]+ [a-z]+"),
    ("ncsa", "associated documentation files the software to deal with", r"associated documentation files the software to deal with the software without restriction"),
    ("postgresql", "permission to use copy modify and distribute this software and its documentation", r"permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement"),
    ("hpnd", "and that both that copyright notice and this permission notice", r"and that both that copyright notice and this permission notice appear in supporting documentation"),
    ("curl", "permission to use copy modify and distribute this software for any purpose", r"permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that"),
    ("ms-pl", "if you use the software you accept this license", r"this licen[cs]e governs use of the accompanying software if you use the software you accept this licen[cs]e"),
    ("ms-rl", "reciprocal grants for any file you distribute", r"reciprocal grants for any file you distribute that contains code from the software"),
    ("sspl-1.0", "make the functionality of the program or a modified version available", r"if you make the functionality of the program or a modified version available to third parties as a service"),
    ("busl-1.1", "business source license 1 1 parameters", r"business source licen[cs]e 1 1 (?:parameters|licensor)"),
    ("busl-1.1", "change license", r"additional use grant .{0,200}?change date .{0,100}?change licen[cs]e"),
    ("commons-clause", "commons clause license condition", r"commons clause licen[cs]e condition v1 0"),
    ("elastic-2.0", "you may not provide the software to third parties as a hosted", r"you may not provide the software to third parties as a hosted or managed service"),
    ("odbl-1.0", "database is made available under the open database", r"this (?:[a-z0-9]+ )?database is made available under the open database licen[cs]e"),
    ("pddl-1.0", "is made available under the public domain dedication", r"is made available under the public domain dedication and licen[cs]e"),
    ("wtfpl", "you just do what the", r"you just do what the [a-z]+ you want to"),
    ("beerware", "buy me a beer", r"if we meet some day and you think this stuff is worth it you can buy me a beer"),
    ("jsonorg", "the software shall be used for good not evil", r"the software shall be used for good not evil"),
    ("sleepycat", "redistributions in any form must be accompanied by information", r"redistributions in any form must be accompanied by information on how to obtain complete source code"),
    ("ijg", "independent jpeg group", r"this software is based in part on the work of the independent jpeg group"),
    ("unicode", "unicode inc license agreement", r"unicode inc licen[cs]e agreement data files and software"),
    ("w3c", "software notice and license", r"w3c (?:r )?software notice and licen[cs]e"),
    ("naist", "nara institute of science and technology", r"nara institute of science and technology all rights reserved"),
    ("vim", "there are no restrictions on distributing unmodified copies of vim", r"there are no restrictions on distributing unmodified copies of vim"),
    ("bzip2", "the origin of this software must not be misrepresented you must not claim", r"the origin of this software must not be misrepresented you must not claim that you wrote the original software if you use this software in a product"),
    ("gutenberg", "project gutenberg license", r"(?:terms of )?the (?:full )?project gutenberg licen[cs]e"),
    ("gutenberg", "almost no restrictions whatsoever", r"with almost no restrictions whatsoever you may copy it give it away or re use it"),
    ("ogl-3.0", "open government license", r"contains public sector information licen[cs]ed under the open government licen[cs]e v3 0"),
)
#: Declarations made for machines and headers of files.
HEADERS = (
    ("gpl-2.0-only", "spdx license identifier gpl 2 0", r"spdx licen[cs]e identifier gpl 2 0(?: only)?(?! or later)"),
    ("gpl-2.0-or-later", "spdx license identifier gpl 2 0", r"spdx licen[cs]e identifier gpl 2 0 or later"),
    ("gpl-3.0-only", "spdx license identifier gpl 3 0", r"spdx licen[cs]e identifier gpl 3 0(?: only)?(?! or later)"),
    ("gpl-3.0-or-later", "spdx license identifier gpl 3 0", r"spdx licen[cs]e identifier gpl 3 0 or later"),
    ("lgpl-2.1-only", "spdx license identifier lgpl 2 1", r"spdx licen[cs]e identifier lgpl 2 1(?: only)?(?! or later)"),
    ("lgpl-2.1-or-later", "spdx license identifier lgpl 2 1", r"spdx licen[cs]e identifier lgpl 2 1 or later"),
    ("lgpl-3.0-only", "spdx license identifier lgpl 3 0", r"spdx licen[cs]e identifier lgpl 3 0(?: only)?(?! or later)"),
    ("lgpl-3.0-or-later", "spdx license identifier lgpl 3 0", r"spdx licen[cs]e identifier lgpl 3 0 or later"),
    ("agpl-3.0-only", "spdx license identifier agpl 3 0", r"spdx licen[cs]e identifier agpl 3 0(?: only)?(?! or later)"),
    ("agpl-3.0-or-later", "spdx license identifier agpl 3 0", r"spdx licen[cs]e identifier agpl 3 0 or later"),
    ("mit", "spdx license identifier mit", r"spdx licen[cs]e identifier mit(?! 0)"),
    ("mit-0", "spdx license identifier mit 0", r"spdx licen[cs]e identifier mit 0"),
    ("apache-2.0", "spdx license identifier apache 2 0", r"spdx licen[cs]e identifier apache 2 0"),
    ("bsd-2-clause", "spdx license identifier bsd 2 clause", r"spdx licen[cs]e identifier bsd 2 clause"),
    ("bsd-3-clause", "spdx license identifier bsd 3 clause", r"spdx licen[cs]e identifier bsd 3 clause"),
    ("0bsd", "spdx license identifier 0bsd", r"spdx licen[cs]e identifier 0bsd"),
    ("isc", "spdx license identifier isc", r"spdx licen[cs]e identifier isc"),
    ("zlib", "spdx license identifier zlib", r"spdx licen[cs]e identifier zlib"),
    ("mpl-2.0", "spdx license identifier mpl 2 0", r"spdx licen[cs]e identifier mpl 2 0"),
    ("epl-2.0", "spdx license identifier epl 2 0", r"spdx licen[cs]e identifier epl 2 0"),
    ("cc0-1.0", "spdx license identifier cc0 1 0", r"spdx licen[cs]e identifier cc0 1 0"),
    ("cc-by-4.0", "spdx license identifier cc by 4 0", r"spdx licen[cs]e identifier cc by 4 0"),
    ("cc-by-sa-4.0", "spdx license identifier cc by sa 4 0", r"spdx licen[cs]e identifier cc by sa 4 0"),
    ("unlicense", "spdx license identifier unlicense", r"spdx licen[cs]e identifier unlicense"),
    ("boost-1.0", "spdx license identifier bsl 1 0", r"spdx licen[cs]e identifier bsl 1 0"),
    ("other", "spdx license identifier", r"spdx licen[cs]e identifier licenseref [^ ]+"),
    ("cc-by-4.0", "creativecommons org licenses by 4 0", r"creativecommons org licenses by 4 0"),
    ("cc-by-3.0", "creativecommons org licenses by 3 0", r"creativecommons org licenses by 3 0"),
    ("cc-by-2.0", "creativecommons org licenses by 2 0", r"creativecommons org licenses by 2 0"),
    ("cc-by-sa-4.0", "creativecommons org licenses by sa 4 0", r"creativecommons org licenses by sa 4 0"),
    ("cc-by-sa-3.0", "creativecommons org licenses by sa 3 0", r"creativecommons org licenses by sa 3 0"),
    ("cc-by-nc-4.0", "creativecommons org licenses by nc 4 0", r"creativecommons org licenses by nc 4 0"),
    ("cc-by-nc-sa-4.0", "creativecommons org licenses by nc sa 4 0", r"creativecommons org licenses by nc sa 4 0"),
    ("cc-by-nc-nd-4.0", "creativecommons org licenses by nc nd 4 0", r"creativecommons org licenses by nc nd 4 0"),
    ("cc-by-nd-4.0", "creativecommons org licenses by nd 4 0", r"creativecommons org licenses by nd 4 0"),
    ("cc0-1.0", "creativecommons org publicdomain zero 1 0", r"creativecommons org publicdomain zero 1 0"),
    ("public-domain", "creativecommons org publicdomain mark", r"creativecommons org publicdomain mark 1 0"),
    ("apache-2.0", "apache org licenses license 2 0", r"(?:www )?apache org licenses license 2 0"),
    ("gpl", "gnu org licenses gpl", r"gnu org licenses gpl(?: [0-9] [0-9])?"),
    ("lgpl", "gnu org licenses lgpl", r"gnu org licenses lgpl(?: [0-9] [0-9])?"),
    ("agpl", "gnu org licenses agpl", r"gnu org licenses agpl(?: [0-9] [0-9])?"),
    ("gfdl", "gnu org licenses fdl", r"gnu org licenses fdl(?: [0-9] [0-9])?"),
    ("mpl-2.0", "mozilla org mpl 2 0", r"mozilla org mpl 2 0"),
    ("mit", "opensource org licenses mit", r"opensource org licenses mit"),
    ("bsd-3-clause", "opensource org licenses bsd 3 clause", r"opensource org licenses bsd 3 clause"),
    ("bsd-2-clause", "opensource org licenses bsd 2 clause", r"opensource org licenses bsd 2 clause"),
    ("epl-2.0", "eclipse org legal epl 2 0", r"eclipse org legal epl 2 0"),
    ("epl-1.0", "eclipse org legal epl v10", r"eclipse org legal epl v10"),
    ("ofl-1.1", "scripts sil org ofl", r"scripts sil org ofl"),
    ("unlicense", "unlicense org", r"unlicense org"),
    ("mit", "license mit", r"licen[cs]e mit(?= (?:author|version|name|copyright|keywords))"),
    ("osi", "license osi approved", r"licen[cs]e osi approved (?:[a-z]+ ){1,4}licen[cs]e"),
    ("mit", "osi approved mit license", r"osi approved mit licen[cs]e"),
    ("apache-2.0", "osi approved apache software license", r"osi approved apache software licen[cs]e"),
    ("gpl-3.0-or-later", "general public license v3 or later gplv3", r"general public licen[cs]e v3 or later gplv3"),
    ("gpl-2.0-or-later", "general public license v2 or later gplv2", r"general public licen[cs]e v2 or later gplv2"),
)
#: Versions written as one word, and names in running text that the forms of a name do not cover.
NAMES = (
    ("gpl-2.0", "gplv2", r"gplv2(?: ?0)?"),
    ("gpl-3.0", "gplv3", r"gplv3(?: ?0)?"),
    ("gpl-1.0", "gplv1", r"gplv1"),
    ("gpl-2.0", "gpl2", r"gpl2"),
    ("gpl-3.0", "gpl3", r"gpl3"),
    ("lgpl-2.0", "lgplv2", r"lgplv2(?! 1)"),
    ("lgpl-2.1", "lgplv2 1", r"lgplv2 1"),
    ("lgpl-3.0", "lgplv3", r"lgplv3"),
    ("agpl-3.0", "agplv3", r"agplv3"),
    ("gpl-2.0-or-later", "gplv2", r"gplv2 or later"),
    ("gpl-3.0-or-later", "gplv3", r"gplv3 or later"),
    ("apache-2.0", "asl 2 0", r"asl 2 0"),
    ("apache-2.0", "alv2", r"alv2"),
    ("apache-2.0", "apache2", r"apache2(?: 0)? licen[cs]e"),
    ("mpl-2.0", "mplv2", r"mplv2(?: 0)?"),
    ("mpl-1.1", "mplv1 1", r"mplv1 1"),
    ("cc-by-4.0", "cc by 4 0", r"cc by 4 0"),
    ("cc-by-3.0", "cc by 3 0", r"cc by 3 0"),
    ("cc-by-sa-4.0", "cc by sa 4 0", r"cc by sa 4 0"),
    ("cc-by-sa-3.0", "cc by sa 3 0", r"cc by sa 3 0"),
    ("cc-by-nc-4.0", "cc by nc 4 0", r"cc by nc 4 0"),
    ("cc-by-nc-sa-4.0", "cc by nc sa 4 0", r"cc by nc sa 4 0"),
    ("cc-by-nc-nd-4.0", "cc by nc nd 4 0", r"cc by nc nd 4 0"),
    ("cc-by-nd-4.0", "cc by nd 4 0", r"cc by nd 4 0"),
    ("cc0-1.0", "cc0 1 0", r"cc0 1 0(?: universal)?"),
    ("cc-by", "creative commons attribution", r"creative commons attribution (?:4|3|2) [05] (?:international|unported|generic)"),
    ("cc", "some rights reserved", r"some rights reserved"),
    ("bsd-3-clause", "3 clause bsd", r"3 clause bsd(?: licen[cs]e)?"),
    ("bsd-2-clause", "2 clause bsd", r"2 clause bsd(?: licen[cs]e)?"),
    ("bsd", "bsd style license", r"bsd style licen[cs]e"),
    ("mit", "expat license", r"expat licen[cs]e"),
    ("mit", "mit style license", r"mit style licen[cs]e"),
    ("bsd-3-clause", "revised bsd", r"revised bsd licen[cs]e"),
    ("gpl-mit", "dual mit gpl", r"dual mit gpl"),
    ("gpl-bsd", "dual bsd gpl", r"dual bsd gpl"),
    ("dual", "dual licensed under", r"dual licen[cs]ed under (?:the )?[a-z]+"),
    ("copyleft", "copyleft", r"copyleft(?: licen[cs]e)?"),
    ("open-source", "open source license", r"(?:an? )?open source licen[cs]e"),
    ("freeware", "freeware", r"freeware(?: licen[cs]e)?"),
    ("shareware", "shareware", r"shareware(?: licen[cs]e)?"),
)
#: Notices that reserve, allow or forbid, and name no licence.
NOTICES = (
    ("proprietary", "proprietary and confidential", r"proprietary and confidential"),
    ("proprietary", "confidential and proprietary", r"confidential and proprietary"),
    ("proprietary", "may not be", r"may not be (?:reproduced|copied|distributed|transmitted) .{0,60}?without (?:the )?(?:prior )?(?:written )?(?:permission|consent)"),
    ("proprietary", "no part of this", r"no part of this (?:publication|book|work|document|site) may be (?:reproduced|copied|stored)"),
    ("proprietary", "unauthori", r"unauthori[sz]ed (?:copying|reproduction|distribution|use) .{0,60}?(?:is )?(?:strictly )?(?:prohibited|forbidden)"),
    ("proprietary", "trade secret", r"contains? trade secrets?"),
    ("proprietary", "end user license agreement", r"end user licen[cs]e agreement"),
    ("proprietary", "subject to the terms of", r"subject to the terms of (?:the|a|your) (?:commercial )?licen[cs]e agreement"),
    ("proprietary", "for internal use only", r"for internal use only"),
    ("noncommercial", "commercial", r"(?:for )?non ?commercial (?:use|purposes) only"),
    ("noncommercial", "not for commercial use", r"not for commercial use"),
    ("noncommercial", "commercial use", r"commercial use (?:is )?(?:prohibited|forbidden|not (?:allowed|permitted))"),
    ("noncommercial", "personal", r"for personal (?:and )?non ?commercial use"),
    ("noncommercial", "educational purposes only", r"for educational purposes only"),
    ("noncommercial", "purposes only", r"for (?:academic|research) purposes only"),
    ("public-domain", "public domain", r"(?:released|placed|dedicated) (?:in|into|to) the public domain"),
    ("public-domain", "public domain", r"(?:is|are) in the public domain"),
    ("public-domain", "no copyright", r"no copyright(?: reserved)?"),
    ("public-domain", "work of the united states government", r"work of the united states government"),
    ("attribution", "reproduced with", r"reproduced with (?:the )?(?:kind )?permission(?: of)?"),
    ("attribution", "used by permission", r"used by permission"),
    ("attribution", "reprinted with", r"reprinted with (?:the )?permission"),
    ("attribution", "please cite", r"(?:if you use .{0,40}? )?please cite"),
    ("copyright", "copyright", r"copyright (?:c )?(?:19|20)[0-9][0-9]"),
    ("copyright", "copyright", r"(?:19|20)[0-9][0-9] copyright"),
    ("copyright", "copyright", r"copyright (?:holder|notice|owner)s?"),
    ("copyright", "copr", r"copr (?:19|20)[0-9][0-9]"),
    ("reserved", "all rights", r"all rights (?:are )?(?:strictly )?reserved"),
    ("permission", "permission is", r"permission is (?:hereby )?granted to (?:use|copy|make)"),
    ("permission", "freely", r"(?:may|can) be freely (?:distributed|copied|used|redistributed)"),
    ("permission", "permission", r"(?:without|with) (?:prior|express|written) permission"),
    ("warranty", "without warranty of any kind", r"(?:provided )?as is without warranty of any kind"),
    ("warranty", "no warranty", r"(?:there is|comes with) (?:absolutely )?no warranty"),
    ("terms", "terms of use", r"(?:by using this (?:site|service) you agree to )?(?:the|our) terms of use"),
    ("terms", "terms of service", r"(?:the|our) terms of service"),
    ("licensed", "licen", r"licen[cs]ed under (?:the )?(?:terms of )?(?:the )?[^ ]+"),
    ("licensed", "licen", r"see (?:the )?(?:file )?licen[cs]e(?: txt| md| file)?(?: for details)?"),
)
