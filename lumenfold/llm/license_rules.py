"""The signature rules of the license scan, in order.

A rule has an id, the license it tells of, a priority, a keyword that every match
contains (ASCII, lower case) and a pattern.  Patterns ignore ASCII case; they see texts
with one blank for every run of white space.  An empty license is what the match says
behind its colon.
"""

from __future__ import annotations

from typing import NamedTuple


class Rule(NamedTuple):
    rule_id: str
    license: str
    priority: int
    keyword: str
    pattern: str


# SPDX id, keyword of the name, name as it stands in titles and grants
_NAMES = [
    ("MIT", "mit", r"(?:the )?MIT(?:[ /-]X11)? licen[sc]e"),
    ("MIT-0", "mit", r"MIT No Attribution(?: licen[sc]e)?"),
    ("Expat", "expat", r"Expat licen[sc]e"),
    ("X11", "x11", r"X11 licen[sc]e"),
    ("ISC", "isc", r"(?:the )?ISC licen[sc]e"),
    ("0BSD", "bsd", r"(?:Zero[ -]Clause|0-clause) BSD(?: licen[sc]e)?"),
    ("BSD-1-Clause", "bsd", r"(?:1-clause|one[ -]clause) BSD(?: licen[sc]e)?"),
    ("BSD-2-Clause", "bsd", r"(?:(?:2|two)[ -]clause|simplified|FreeBSD) (?:BSD )?licen[sc]e(?<=BSD licen.e)"),
    ("BSD-3-Clause", "bsd", r"(?:(?:3|three)[ -]clause|new|revised|modified) BSD licen[sc]e"),
    ("BSD-4-Clause", "bsd", r"(?:(?:4|four)[ -]clause|original) BSD licen[sc]e"),
    ("BSD", "bsd", r"BSD[ -]style licen[sc]e"),
    ("BSD-Unspecified", "bsd", r"(?:the )?BSD licen[sc]e"),
    ("Apache-1.0", "apache", r"Apache (?:Software )?Licen[sc]e,? (?:version |v\.? ?)1\.0"),
    ("Apache-1.1", "apache", r"Apache (?:Software )?Licen[sc]e,? (?:version |v\.? ?)1\.1"),
    ("Apache-2.0", "apache", r"Apache (?:Software )?Licen[sc]e,? (?:\(?version |v\.? ?|)2(?:\.0)?\b\)?"),
    ("Apache-Unspecified", "apache", r"Apache (?:Software )?Licen[sc]e"),
    ("GPL-1.0", "general public", r"(?:GNU )?General Public Licen[sc]e,? (?:\(GPL\),? )?(?:version |v\.? ?)1(?:\.0)?\b"),
    ("GPL-2.0", "general public", r"(?:GNU )?General Public Licen[sc]e,? (?:\(GPL\),? )?(?:version |v\.? ?)2(?:\.0)?\b"),
    ("GPL-3.0", "general public", r"(?:GNU )?General Public Licen[sc]e,? (?:\(GPL\),? )?(?:version |v\.? ?)3(?:\.0)?\b"),
    ("GPL-Unspecified", "general public", r"GNU General Public Licen[sc]e"),
    ("GPL-2.0-short", "gpl", r"GNU GPL,? ?(?:version |v\.? ?)2(?:\.0)?\b"),
    ("GPL-3.0-short", "gpl", r"GNU GPL,? ?(?:version |v\.? ?)3(?:\.0)?\b"),
    ("LGPL-2.0", "library general public", r"(?:GNU )?Library General Public Licen[sc]e"),
    ("LGPL-2.1", "lesser general public", r"(?:GNU )?Lesser General Public Licen[sc]e,? (?:version |v\.? ?)2(?:\.1)?\b"),
    ("LGPL-3.0", "lesser general public", r"(?:GNU )?Lesser General Public Licen[sc]e,? (?:version |v\.? ?)3(?:\.0)?\b"),
    ("LGPL-Unspecified", "lesser general public", r"(?:GNU )?Lesser General Public Licen[sc]e"),
    ("AGPL-1.0", "affero general public", r"Affero General Public Licen[sc]e,? (?:version |v\.? ?)1(?:\.0)?\b"),
    ("AGPL-3.0", "affero general public", r"(?:GNU )?Affero General Public Licen[sc]e,? (?:version |v\.? ?)3(?:\.0)?\b"),
    ("AGPL-Unspecified", "affero general public", r"(?:GNU )?Affero General Public Licen[sc]e"),
    ("GFDL-1.1", "free documentation", r"(?:GNU )?Free Documentation Licen[sc]e,? (?:version |v\.? ?)1\.1"),
    ("GFDL-1.2", "free documentation", r"(?:GNU )?Free Documentation Licen[sc]e,? (?:version |v\.? ?)1\.2"),
    ("GFDL-1.3", "free documentation", r"(?:GNU )?Free Documentation Licen[sc]e,? (?:version |v\.? ?)1\.3"),
    ("GFDL-Unspecified", "free documentation", r"(?:GNU )?Free Documentation Licen[sc]e"),
    ("MPL-1.0", "mozilla public", r"Mozilla Public Licen[sc]e,? (?:version |v\.? ?)1\.0"),
    ("MPL-1.1", "mozilla public", r"Mozilla Public Licen[sc]e,? (?:version |v\.? ?)1\.1"),
    ("MPL-2.0", "mozilla public", r"Mozilla Public Licen[sc]e,? (?:version |v\.? ?)?2(?:\.0)?\b"),
    ("MPL-Unspecified", "mozilla public", r"Mozilla Public Licen[sc]e"),
    ("EPL-1.0", "eclipse public", r"Eclipse Public Licen[sc]e,? (?:- )?(?:version |v\.? ?)?1\.0"),
    ("EPL-2.0", "eclipse public", r"Eclipse Public Licen[sc]e,? (?:- )?(?:version |v\.? ?)?2\.0"),
    ("EPL-Unspecified", "eclipse public", r"Eclipse Public Licen[sc]e"),
    ("EDL-1.0", "eclipse distribution", r"Eclipse Distribution Licen[sc]e"),
    ("CDDL-1.0", "common development and distribution", r"Common Development and Distribution Licen[sc]e,? (?:\(CDDL\),? )?(?:version |v\.? ?)1\.0"),
    ("CDDL-1.1", "common development and distribution", r"Common Development and Distribution Licen[sc]e,? (?:\(CDDL\),? )?(?:version |v\.? ?)1\.1"),
    ("CDDL-Unspecified", "common development and distribution", r"Common Development and Distribution Licen[sc]e"),
    ("CPL-1.0", "common public", r"Common Public Licen[sc]e"),
    ("CPAL-1.0", "common public attribution", r"Common Public Attribution Licen[sc]e"),
    ("IPL-1.0", "ibm public", r"IBM Public Licen[sc]e"),
    ("APSL-2.0", "apple public", r"Apple Public Source Licen[sc]e"),
    ("Artistic-1.0", "artistic", r"Artistic Licen[sc]e,? (?:version |v\.? ?)?1(?:\.0)?\b"),
    ("Artistic-2.0", "artistic", r"Artistic Licen[sc]e,? (?:version |v\.? ?)?2(?:\.0)?\b"),
    ("Artistic-Unspecified", "artistic", r"(?:Perl )?Artistic Licen[sc]e"),
    ("BSL-1.0", "boost software", r"Boost Software Licen[sc]e"),
    ("BUSL-1.1", "business source", r"Business Source Licen[sc]e"),
    ("SSPL-1.0", "server side public", r"Server Side Public Licen[sc]e"),
    ("Elastic-2.0", "elastic", r"Elastic Licen[sc]e(?:,? (?:version |v\.? ?)?2(?:\.0)?\b)?"),
    ("EUPL-1.1", "european union public", r"European Union Public Licen[sc]e,? (?:\(EUPL\),? )?(?:version |v\.? ?)?1\.1"),
    ("EUPL-1.2", "european union public", r"European Union Public Licen[sc]e,? (?:\(EUPL\),? )?(?:version |v\.? ?)?1\.2"),
    ("EUPL-Unspecified", "european union public", r"European Union Public Licen[sc]e"),
    ("CECILL-2.1", "cecill", r"CeCILL(?:[ -][BC])?(?: Free Software)? Licen[sc]e"),
    ("Zlib", "zlib", r"zlib(?:/libpng)? licen[sc]e"),
    ("Libpng", "libpng", r"(?<!/)libpng licen[sc]e"),
    ("PNG-Reference", "png reference", r"PNG Reference Library Licen[sc]e"),
    ("IJG", "independent jpeg", r"Independent JPEG Group(?:'s)? (?:licen[sc]e|software)"),
    ("PSF-2.0", "python software foundation", r"Python Software Foundation Licen[sc]e"),
    ("Python-2.0", "python", r"Python Licen[sc]e(?:,? (?:version |v\.? ?)?2(?:\.0)?\b)?"),
    ("PHP-3.01", "php", r"(?:the )?PHP Licen[sc]e(?:,? (?:version |v\.? ?)?3\.01?)?"),
    ("Ruby", "ruby", r"(?:the )?Ruby Licen[sc]e"),
    ("OpenSSL", "openssl", r"OpenSSL Licen[sc]e"),
    ("SSLeay", "ssleay", r"(?:original )?SSLeay Licen[sc]e"),
    ("curl", "curl", r"curl licen[sc]e"),
    ("Unlicense", "unlicense", r"(?:the )?Unlicense\b"),
    ("WTFPL", "wtfpl", r"\bWTFPL\b(?:,? (?:version |v\.? ?)?2)?"),
    ("WTFPL-long", "what the f", r"Do What The F\S* You Want To Public Licen[sc]e"),
    ("Beerware", "beer", r"beer-?ware licen[sc]e"),
    ("PostgreSQL", "postgresql", r"PostgreSQL Licen[sc]e"),
    ("NCSA", "ncsa", r"(?:University of Illinois/)?NCSA (?:Open Source )?Licen[sc]e"),
    ("UPL-1.0", "universal permissive", r"Universal Permissive Licen[sc]e"),
    ("OFL-1.1", "open font", r"(?:SIL )?Open Font Licen[sc]e"),
    ("Ubuntu-font", "ubuntu font", r"Ubuntu Font Licen[sc]e"),
    ("W3C", "w3c", r"W3C (?:Software (?:and Document )?(?:Notice and )?)?Licen[sc]e"),
    ("Vim", "vim", r"\bVim licen[sc]e"),
    ("LPPL-1.3c", "latex project public", r"LaTeX Project Public Licen[sc]e"),
    ("MS-PL", "microsoft public", r"Microsoft Public Licen[sc]e"),
    ("MS-RL", "microsoft reciprocal", r"Microsoft Reciprocal Licen[sc]e"),
    ("QPL-1.0", "q public", r"\bQ Public Licen[sc]e"),
    ("Sleepycat", "sleepycat", r"Sleepycat Licen[sc]e"),
    ("NPL-1.1", "netscape public", r"Netscape Public Licen[sc]e"),
    ("SPL-1.0", "sun public", r"Sun Public Licen[sc]e"),
    ("RPL-1.5", "reciprocal public", r"Reciprocal Public Licen[sc]e"),
    ("OSL-3.0", "open software licen", r"Open Software Licen[sc]e(?:,? (?:version |v\.? ?)?3\.0)?"),
    ("AFL-3.0", "academic free", r"Academic Free Licen[sc]e(?:,? (?:version |v\.? ?)?\d\.\d)?"),
    ("ECL-2.0", "educational community", r"Educational Community Licen[sc]e"),
    ("MulanPSL-2.0", "mulan", r"Mulan (?:PSL|Permissive Software Licen[sc]e)"),
    ("BlueOak-1.0.0", "blue oak", r"Blue Oak Model Licen[sc]e"),
    ("Hippocratic-2.1", "hippocratic", r"Hippocratic Licen[sc]e"),
    ("ODbL-1.0", "open data", r"Open (?:Data Commons Open )?Data(?:base)? Licen[sc]e"),
    ("ODbL-database", "open database", r"Open Database Licen[sc]e"),
    ("ODC-By-1.0", "open data commons attribution", r"Open Data Commons Attribution Licen[sc]e"),
    ("PDDL-1.0", "public domain dedication", r"Public Domain Dedication and Licen[sc]e"),
    ("OGL-UK-3.0", "open government", r"Open Government Licen[sc]e"),
    ("OpenRAIL", "openrail", r"(?:BigScience |CreativeML )?Open ?RAIL(?:[+-]?\+*M)?(?: licen[sc]e)?"),
    ("Llama-Community", "community licen", r"Llama \d(?:\.\d)? Community Licen[sc]e"),
    ("CC0-1.0", "cc0", r"\bCC0(?:[ -]1\.0)?(?: Universal)?\b"),
    ("CC-BY", "creative commons", r"Creative Commons Attribution(?: Licen[sc]e)?(?: \d\.\d)?(?: International| Unported| Generic)?"),
    ("CC-BY-SA", "creative commons", r"Creative Commons Attribution[ -]Share ?Alike(?: Licen[sc]e)?(?: \d\.\d)?(?: International| Unported| Generic)?"),
    ("CC-BY-NC", "creative commons", r"Creative Commons Attribution[ -]Non-?Commercial(?: Licen[sc]e)?(?: \d\.\d)?(?: International| Unported| Generic)?"),
    ("CC-BY-ND", "creative commons", r"Creative Commons Attribution[ -]No ?Deriv(?:ative)?s(?: Works)?(?: Licen[sc]e)?(?: \d\.\d)?(?: International| Unported| Generic)?"),
    ("CC-BY-NC-SA", "creative commons", r"Creative Commons Attribution[ -]Non-?Commercial[ -]Share ?Alike(?: Licen[sc]e)?(?: \d\.\d)?(?: International| Unported| Generic)?"),
    ("CC-BY-NC-ND", "creative commons", r"Creative Commons Attribution[ -]Non-?Commercial[ -]No ?Deriv(?:ative)?s(?: Works)?(?: Licen[sc]e)?(?: \d\.\d)?(?: International| Unported| Generic)?"),
    ("CC-Unspecified", "creative commons", r"Creative Commons licen[sc]e"),
    ("CC-BY-short", "cc", r"\bCC[ -]BY(?:[ -]\d\.\d)?\b(?![ -](?:NC|SA|ND))"),
    ("CC-BY-SA-short", "cc", r"\bCC[ -]BY[ -]SA(?:[ -]\d\.\d)?\b"),
    ("CC-BY-NC-short", "cc", r"\bCC[ -]BY[ -]NC(?:[ -]\d\.\d)?\b(?![ -](?:SA|ND))"),
    ("CC-BY-ND-short", "cc", r"\bCC[ -]BY[ -]ND(?:[ -]\d\.\d)?\b"),
    ("CC-BY-NC-SA-short", "cc", r"\bCC[ -]BY[ -]NC[ -]SA(?:[ -]\d\.\d)?\b"),
    ("CC-BY-NC-ND-short", "cc", r"\bCC[ -]BY[ -]NC[ -]ND(?:[ -]\d\.\d)?\b"),
]

# SPDX id, pattern of the page
_PAGES = [
    ("MIT", r"opensource\.org/licen[sc]es?/mit\b"),
    ("ISC", r"opensource\.org/licen[sc]es?/isc\b"),
    ("0BSD", r"opensource\.org/licen[sc]es?/0bsd\b"),
    ("BSD-2-Clause", r"opensource\.org/licen[sc]es?/bsd-2-clause\b"),
    ("BSD-3-Clause", r"opensource\.org/licen[sc]es?/bsd-3-clause\b"),
    ("BSD", r"opensource\.org/licen[sc]es?/bsd-license\b"),
    ("Zlib", r"opensource\.org/licen[sc]es?/zlib\b"),
    ("Artistic-2.0", r"opensource\.org/licen[sc]es?/artistic-license-2\.0"),
    ("MPL-2.0", r"opensource\.org/licen[sc]es?/mpl-2\.0"),
    ("MS-PL", r"opensource\.org/licen[sc]es?/ms-pl\b"),
    ("OSL-3.0", r"opensource\.org/licen[sc]es?/osl-3\.0"),
    ("Apache-2.0", r"opensource\.org/licen[sc]es?/apache-2\.0"),
    ("GPL-2.0", r"opensource\.org/licen[sc]es?/gpl-2\.0"),
    ("GPL-3.0", r"opensource\.org/licen[sc]es?/gpl-3\.0"),
    ("LGPL-2.1", r"opensource\.org/licen[sc]es?/lgpl-2\.1"),
    ("LGPL-3.0", r"opensource\.org/licen[sc]es?/lgpl-3\.0"),
    ("Apache-2.0", r"apache\.org/licen[sc]es/licen[sc]e-2\.0"),
    ("Apache-1.1", r"apache\.org/licen[sc]es/licen[sc]e-1\.1"),
    ("GPL-2.0", r"gnu\.org/licen[sc]es/(?:old-licen[sc]es/)?gpl-2\.0"),
    ("GPL-3.0", r"gnu\.org/licen[sc]es/gpl-3\.0"),
    ("LGPL-2.1", r"gnu\.org/licen[sc]es/(?:old-licen[sc]es/)?lgpl-2\.1"),
    ("LGPL-3.0", r"gnu\.org/licen[sc]es/lgpl-3\.0"),
    ("AGPL-3.0", r"gnu\.org/licen[sc]es/agpl-3\.0"),
    ("GFDL-1.3", r"gnu\.org/licen[sc]es/fdl-1\.3"),
    ("GPL-Unspecified", r"gnu\.org/(?:copyleft|licen[sc]es)/gpl\.(?:html|txt)"),
    ("MPL-2.0", r"mozilla\.org/mpl/2\.0"),
    ("MPL-1.1", r"mozilla\.org/mpl/mpl-1\.1"),
    ("EPL-1.0", r"eclipse\.org/legal/epl-v10"),
    ("EPL-2.0", r"eclipse\.org/legal/epl-2\.0"),
    ("BSL-1.0", r"boost\.org/licen[sc]e_1_0"),
    ("Unlicense", r"unlicense\.org"),
    ("WTFPL", r"wtfpl\.net"),
    ("PostgreSQL", r"postgresql\.org/about/licen[sc]e"),
    ("OFL-1.1", r"scripts\.sil\.org/ofl"),
    ("CC0-1.0", r"creativecommons\.org/publicdomain/zero/1\.0"),
    ("CC-PDM", r"creativecommons\.org/publicdomain/mark/1\.0"),
    ("CC-BY-1.0", r"creativecommons\.org/licen[sc]es/by/1\.0"),
    ("CC-BY-2.0", r"creativecommons\.org/licen[sc]es/by/2\.0"),
    ("CC-BY-2.5", r"creativecommons\.org/licen[sc]es/by/2\.5"),
    ("CC-BY-3.0", r"creativecommons\.org/licen[sc]es/by/3\.0"),
    ("CC-BY-4.0", r"creativecommons\.org/licen[sc]es/by/4\.0"),
    ("CC-BY-SA-2.0", r"creativecommons\.org/licen[sc]es/by-sa/2\.0"),
    ("CC-BY-SA-3.0", r"creativecommons\.org/licen[sc]es/by-sa/3\.0"),
    ("CC-BY-SA-4.0", r"creativecommons\.org/licen[sc]es/by-sa/4\.0"),
    ("CC-BY-NC-3.0", r"creativecommons\.org/licen[sc]es/by-nc/3\.0"),
    ("CC-BY-NC-4.0", r"creativecommons\.org/licen[sc]es/by-nc/4\.0"),
    ("CC-BY-ND-4.0", r"creativecommons\.org/licen[sc]es/by-nd/4\.0"),
    ("CC-BY-NC-SA-3.0", r"creativecommons\.org/licen[sc]es/by-nc-sa/3\.0"),
    ("CC-BY-NC-SA-4.0", r"creativecommons\.org/licen[sc]es/by-nc-sa/4\.0"),
    ("CC-BY-NC-ND-4.0", r"creativecommons\.org/licen[sc]es/by-nc-nd/4\.0"),
    ("ODbL-1.0", r"opendatacommons\.org/licen[sc]es/odbl"),
    ("ODC-By-1.0", r"opendatacommons\.org/licen[sc]es/by"),
    ("PDDL-1.0", r"opendatacommons\.org/licen[sc]es/pddl"),
    ("OGL-UK-3.0", r"nationalarchives\.gov\.uk/doc/open-government-licen[sc]e"),
    ("EUPL-1.2", r"joinup\.ec\.europa\.eu/\S{0,80}eupl"),
]

# license, keyword, sentence of the text
_TEXTS = [
    ("MIT", "permission is hereby granted, free of charge", r"Permission is hereby granted, free of charge, to any person obtaining a\s+copy"),
    ("MIT", "the above copyright notice and this permission notice", r"The above copyright notice and this permission notice shall be included in\s+all\s+copies"),
    ("ISC", "permission to use, copy, modify", r"Permission to use, copy, modify, and(?:/or)? distribute this software for any\s+purpose with or without fee is hereby granted"),
    ("BSD", "redistribution and use in source and binary", r"Redistribution and use in source and binary forms, with or without\s+modification, are permitted"),
    ("BSD-3-Clause", "may be used to endorse", r"Neither the names? of .{1,120}? may be used to endorse or promote"),
    ("BSD-4-Clause", "all advertising materials", r"All advertising materials mentioning features or use of this software"),
    ("BSD", "this software is provided by the", r"THIS SOFTWARE IS PROVIDED BY THE (?:COPYRIGHT HOLDERS|REGENTS|AUTHORS?)[^.]{0,80}\"?AS IS"),
    ("MIT", "the software is provided", r"THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND"),
    ("Apache-2.0", "you may not use this file except", r"you may not use this file except in compliance with the Licen[sc]e"),
    ("Apache-2.0", "terms and conditions for use, reproduction", r"TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION"),
    ("Apache-Unspecified", "apache software foundation", r"This product includes software developed (?:by|at) the Apache Software Foundation"),
    ("GPL-Unspecified", "you can redistribute it and/or modify", r"This program is free software[;:] you can redistribute it and/or modify"),
    ("LGPL-Unspecified", "this library is free software", r"This library is free software[;:] you can redistribute it and/or modify"),
    ("GPL-2.0-or-later", "either version 2", r"either version 2 of the Licen[sc]e,? or \(?at your option\)? any later version"),
    ("GPL-3.0-or-later", "either version 3", r"either version 3 of the Licen[sc]e,? or \(?at your option\)? any later version"),
    ("GPL-Unspecified", "without even the implied warranty", r"without even the implied warranty of\s+MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE"),
    ("MPL-2.0", "this source code form is subject", r"This Source Code Form is subject to the terms of the Mozilla Public"),
    ("MPL-1.1", "the contents of this file are subject", r"The contents of this file are subject to the (?:Mozilla|Netscape) Public"),
    ("EPL-1.0", "accompanying materials are made available", r"This program and the accompanying materials are made available under the"),
    ("BSL-1.0", "boost software license", r"Distributed under the Boost Software License, Version 1\.0"),
    ("Unlicense", "unencumbered software", r"This is free and unencumbered software released into the public domain"),
    ("Zlib", "this software is provided 'as-is'", r"This software is provided 'as-is', without any express or implied\s+warranty"),
    ("Beerware", "buy me a beer", r"you can buy me a beer in return"),
    ("WTFPL", "you just do what the f", r"You just DO WHAT THE F\S* YOU WANT TO"),
    ("CC0-1.0", "waive", r"(?:has|have) waived all copyright and related or neighbou?ring rights"),
    ("Public-Domain", "public domain", r"(?:placed|released|dedicated|is) (?:in|into|to) the public domain"),
    ("Public-Domain", "public domain", r"\bno copyright\b.{0,40}\bpublic domain\b"),
    ("Proprietary", "all rights reserved", r"\ball rights reserved\b"),
    ("Proprietary", "confidential", r"proprietary and confidential|confidential and proprietary"),
    ("Proprietary", "unauthori", r"unauthori[sz]ed (?:copying|use|distribution|reproduction) (?:of|or)\b.{0,80}\bprohibited"),
    ("Proprietary", "may not be reproduced", r"may not be reproduced(?:,| or| in)\b.{0,80}\bwithout\b"),
    ("Proprietary", "for internal use only", r"for internal use only"),
    ("Non-Commercial", "non-commercial", r"for (?:personal and |research and )?non-commercial (?:use|purposes) only"),
    ("Non-Commercial", "noncommercial", r"for noncommercial (?:use|purposes) only"),
    ("Copyright", "copyright", r"copyright (?:\(c\)|©|&copy;)? ?(?:19|20)\d\d(?:[ ,-]+(?:19|20)\d\d)*"),
    ("Dual", "dual", r"dual[ -]licen[sc]ed under"),
    ("Perl", "same terms as perl", r"under the same terms as Perl itself"),
    ("Artistic-Unspecified", "the artistic license", r"you can redistribute it .{0,80}the Artistic License"),
    ("OFL-1.1", "reserved font name", r"with Reserved Font Names?"),
    ("PSF-2.0", "psf license agreement", r"PSF LICENSE AGREEMENT FOR PYTHON"),
    ("W3C", "w3c", r"status and prior versions of W3C documents"),
    ("JSON", "good, not evil", r"shall be used for Good, not Evil"),
    ("Commons-Clause", "commons clause", r"Commons Clause(?:\" | )?Licen[sc]e Condition"),
    ("Copyleft", "copyleft", r"\bcopyleft licen[sc]e"),
    ("Open-Source", "open source licen", r"\bopen source licen[sc]e"),
    ("License-Reference", "licen", r"see (?:the )?(?:accompanying )?LICEN[SC]E(?:\.txt|\.md)? file"),
    ("License-Reference", "copying", r"see (?:the )?(?:file )?COPYING(?:\.txt)?\b"),
    ("License-Reference", "terms of use", r"subject to (?:our|the) terms of use"),
]

_SPDX = """MIT MIT-0 ISC 0BSD BSD-1-Clause BSD-2-Clause BSD-2-Clause-Patent BSD-3-Clause BSD-3-Clause-Clear BSD-4-Clause BSL-1.0 Apache-1.0 Apache-1.1 Apache-2.0
GPL-1.0-only GPL-2.0-only GPL-2.0-or-later GPL-3.0-only GPL-3.0-or-later LGPL-2.0-only LGPL-2.1-only LGPL-2.1-or-later LGPL-3.0-only LGPL-3.0-or-later AGPL-3.0-only AGPL-3.0-or-later
GPL-2.0 GPL-3.0 LGPL-2.1 LGPL-3.0 AGPL-3.0 MPL-1.1 MPL-2.0 EPL-1.0 EPL-2.0 CDDL-1.0 CDDL-1.1 EUPL-1.1 EUPL-1.2 Artistic-1.0 Artistic-2.0 Zlib Libpng Unlicense WTFPL Beerware
CC0-1.0 CC-BY-3.0 CC-BY-4.0 CC-BY-SA-3.0 CC-BY-SA-4.0 CC-BY-NC-4.0 CC-BY-NC-SA-4.0 CC-BY-NC-ND-4.0 CC-BY-ND-4.0 PostgreSQL NCSA UPL-1.0 OFL-1.1 PSF-2.0 Python-2.0 PHP-3.01 Ruby
OpenSSL curl Vim W3C LPPL-1.3c MS-PL MS-RL QPL-1.0 Sleepycat NPL-1.1 OSL-3.0 AFL-3.0 ECL-2.0 MulanPSL-2.0 BlueOak-1.0.0 ODbL-1.0 ODC-By-1.0 PDDL-1.0 SSPL-1.0 BUSL-1.1 Elastic-2.0 HPND Unicode-DFS-2016""".split()

_GRANT = r"(?:dual[ -])?(?:licen[sc]ed|released|distributed|published|(?:made )?available|provided|covered|shared) (?:under|by|with)(?: the terms of)?(?: an?| the)? "


def _rules() -> list[Rule]:
    one, many = r"[A-Za-z0-9][\w.:-]*\+?", r"(?: ?\)){0,9} (?:AND|OR|WITH) (?:\( ?){0,9}"
    found = [Rule("spdx-expression", "", 110, "spdx-license-identifier", rf"SPDX-License-Identifier: ?(?:\( ?){{0,9}}{one}(?:{many}{one})+(?: ?\)){{0,9}}")]
    found += [Rule(f"spdx:{x}", x, 100, "spdx-license-identifier", r"SPDX-License-Identifier:\s{0,4}\(?" + x.replace(".", r"\.") + r"(?![\w.+-])") for x in _SPDX]
    found += [Rule("spdx-other", "", 90, "spdx-license-identifier", rf"SPDX-License-Identifier: ?(?:\( ?)?{one}(?: ?\))?")]
    found += [Rule(f"grant:{x}", x.removesuffix("-short").removesuffix("-long"), 80, keyword, _GRANT + f"(?:{name})") for x, keyword, name in _NAMES]
    found += [Rule(f"page:{i:02}:{x}", x, 70, p.split(r"\.")[0].split("/")[0], r"(?:https?://)?(?:www\.)?" + p) for i, (x, p) in enumerate(_PAGES)]
    found += [Rule(f"text:{i:02}:{x}", x, 60, keyword, p) for i, (x, keyword, p) in enumerate(_TEXTS)]
    found += [Rule(f"name:{x}", x.removesuffix("-short").removesuffix("-long"), 40, keyword, name) for x, keyword, name in _NAMES]
    return found


RULES = _rules()
