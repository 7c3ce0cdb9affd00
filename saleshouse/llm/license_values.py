"""Fixed values of the license scan: names, forms and notices. All are over words in lower case with single spaces."""

from __future__ import annotations

# Label, keyword that a text must hold, and a pattern of the name.
NAMES = [
    ("0bsd", "bsd", r"(?:zero clause|0) ?bsd"),
    ("afl-3.0", "academic", r"academic free license(?: v| version)? ?3(?: 0)?"),
    ("agpl-1.0", "affero", r"affero general public license(?: v| version)? ?1(?: 0)?"),
    ("agpl-3.0", "affero", r"(?:gnu )?affero general public license(?: v| version)? ?3(?: 0)?"),
    ("apache-1.0", "apache", r"apache(?: software)? license(?: v| version)? ?1(?: 0)?"),
    ("apache-1.1", "apache", r"apache(?: software)? license(?: v| version)? ?1 1"),
    ("apache-2.0", "apache", r"apache(?: license)?(?: v| version)? ?2(?: 0)?(?: license)?"),
    ("artistic-1.0", "artistic", r"artistic license(?: v| version)? ?1(?: 0)?"),
    ("artistic-2.0", "artistic", r"artistic license(?: v| version)? ?2(?: 0)?"),
    ("boost-1.0", "boost", r"boost software license(?: v| version)?(?: ?1 0)?"),
    ("bsd-1-clause", "bsd", r"(?:bsd 1 clause|1 clause bsd)(?: license)?"),
    ("bsd-2-clause", "bsd", r"(?:bsd 2 clause|(?:2|two) clause bsd|simplified bsd|freebsd)(?: license)?"),
    ("bsd-3-clause", "bsd", r"(?:bsd 3 clause|(?:3|three) clause bsd|new bsd|modified bsd|revised bsd)(?: license)?"),
    ("bsd-4-clause", "bsd", r"(?:bsd 4 clause|(?:4|four) clause bsd|original bsd)(?: license)?"),
    ("bsd", "bsd", r"bsd(?: style)? license"),
    ("bsl-1.1", "business", r"business source license(?: v| version)?(?: ?1 1)?"),
    ("cc0-1.0", "cc0", r"cc0(?: ?1 0)?(?: universal)?"),
    ("cc-by-1.0", "cc by", r"cc by 1 0"),
    ("cc-by-2.0", "cc by", r"cc by 2 0"),
    ("cc-by-2.5", "cc by", r"cc by 2 5"),
    ("cc-by-3.0", "cc by", r"cc by 3 0"),
    ("cc-by-4.0", "cc by", r"cc by 4 0"),
    ("cc-by-nc-2.0", "cc by", r"cc by nc 2 0"),
    ("cc-by-nc-3.0", "cc by", r"cc by nc 3 0"),
    ("cc-by-nc-4.0", "cc by", r"cc by nc 4 0"),
    ("cc-by-nc-nd-3.0", "cc by", r"cc by nc nd 3 0"),
    ("cc-by-nc-nd-4.0", "cc by", r"cc by nc nd 4 0"),
    ("cc-by-nc-sa-3.0", "cc by", r"cc by nc sa 3 0"),
    ("cc-by-nc-sa-4.0", "cc by", r"cc by nc sa 4 0"),
    ("cc-by-nd-3.0", "cc by", r"cc by nd 3 0"),
    ("cc-by-nd-4.0", "cc by", r"cc by nd 4 0"),
    ("cc-by-sa-2.0", "cc by", r"cc by sa 2 0"),
    ("cc-by-sa-3.0", "cc by", r"cc by sa 3 0"),
    ("cc-by-sa-4.0", "cc by", r"cc by sa 4 0"),
    ("cc-by-nc", "cc by", r"cc by nc"),
    ("cc-by-nc-nd", "cc by", r"cc by nc nd"),
    ("cc-by-nc-sa", "cc by", r"cc by nc sa"),
    ("cc-by-nd", "cc by", r"cc by nd"),
    ("cc-by-sa", "cc by", r"cc by sa"),
    ("cddl-1.0", "common development", r"common development and distribution license(?: v| version)?(?: ?1 0)?"),
    ("cecill-2.1", "cecill", r"cecill(?: license)?(?: v| version)? ?2 1"),
    ("cpl-1.0", "common public", r"common public license(?: v| version)?(?: ?1 0)?"),
    ("creative-commons-by", "creative commons", r"creative commons attribution(?: \d \d)?(?: international| unported| generic)?"),
    ("creative-commons-by-nc", "creative commons", r"creative commons attribution non ?commercial(?: \d \d)?"),
    ("creative-commons-by-nd", "creative commons", r"creative commons attribution no ?deriv(?:ative|ative)s?(?: \d \d)?"),
    ("creative-commons-by-sa", "creative commons", r"creative commons attribution share ?alike(?: \d \d)?"),
    ("ecl-2.0", "educational", r"educational community license(?: v| version)?(?: ?2 0)?"),
    ("epl-1.0", "eclipse", r"eclipse public license(?: v| version)? ?1(?: 0)?"),
    ("epl-2.0", "eclipse", r"eclipse public license(?: v| version)? ?2(?: 0)?"),
    ("eupl-1.2", "european union", r"european union public licen[cs]e(?: v| version)?(?: ?1 2)?"),
    ("gfdl-1.2", "free documentation", r"(?:gnu )?free documentation license(?: v| version)? ?1 2"),
    ("gfdl-1.3", "free documentation", r"(?:gnu )?free documentation license(?: v| version)? ?1 3"),
    ("gpl-1.0", "general public", r"(?:gnu )?general public license(?: v| version)? ?1(?: 0)?"),
    ("gpl-2.0", "general public", r"(?:gnu )?general public license(?: v| version)? ?2(?: 0)?"),
    ("gpl-3.0", "general public", r"(?:gnu )?general public license(?: v| version)? ?3(?: 0)?"),
    ("isc", "isc", r"isc license"),
    ("lgpl-2.0", "general public", r"(?:gnu )?library general public license(?: v| version)? ?2(?: 0)?"),
    ("lgpl-2.1", "general public", r"(?:gnu )?lesser general public license(?: v| version)? ?2 1"),
    ("lgpl-3.0", "general public", r"(?:gnu )?lesser general public license(?: v| version)? ?3(?: 0)?"),
    ("mit", "mit", r"mit license"),
    ("mpl-1.1", "mozilla", r"mozilla public license(?: v| version)? ?1 1"),
    ("mpl-2.0", "mozilla", r"mozilla public license(?: v| version)? ?2(?: 0)?"),
    ("ms-pl", "microsoft", r"microsoft public license"),
    ("ms-rl", "microsoft", r"microsoft reciprocal license"),
    ("ncsa", "ncsa", r"(?:university of illinois )?ncsa(?: open source)? license"),
    ("odbl-1.0", "open database", r"open database license(?: v| version)?(?: ?1 0)?"),
    ("ofl-1.1", "open font", r"(?:sil )?open font license(?: v| version)?(?: ?1 1)?"),
    ("openssl", "openssl", r"openssl license"),
    ("osl-3.0", "open software", r"open software license(?: v| version)?(?: ?3 0)?"),
    ("php-3.01", "php", r"php license(?: v| version)?(?: ?3 01)?"),
    ("postgresql", "postgresql", r"postgresql licen[cs]e"),
    ("python-2.0", "python", r"python(?: software foundation)? license(?: v| version)?(?: ?2(?: 0)?)?"),
    ("sspl-1.0", "server side", r"server side public license(?: v| version)?(?: ?1)?"),
    ("unlicense", "unlicense", r"the unlicense"),
    ("vim", "vim", r"vim license"),
    ("wtfpl", "wtfpl", r"wtfpl"),
    ("zlib", "zlib", r"zlib(?: libpng)? license"),
    ("zpl-2.1", "zope", r"zope public license(?: v| version)?(?: ?2 1)?"),
]

# Form, pattern around {name}, priority (1 is first) and confidence.
FORMS = [
    ("identifier", r"spdx license identifier {name}", 1, 1.0),
    ("notice", r"(?:licensed|released|distributed|available|published|covered|provided|shared)(?: to you)? under(?: the)?(?: terms (?:and conditions )?of)?(?: the| a| an)? {name}", 2, 0.95),
    ("terms", r"(?:subject to|governed by|in accordance with|terms of)(?: the)? {name}", 3, 0.85),
    ("heading", r"licen[cs]e {name}", 4, 0.8),
    ("name", r"{name}", 5, 0.6),
]

# Label, keyword, pattern of a sentence that needs no name; priority 1.
NOTICES = [
    ("apache-2.0", "apache org", r"(?:www )?apache org licenses license 2 0"),
    ("bsd", "redistribution and use", r"redistribution and use in source and binary forms with or without modification are permitted"),
    ("cc-by", "creativecommons org", r"creativecommons org licenses by \d \d"),
    ("cc-by-nc", "creativecommons org", r"creativecommons org licenses by nc \d \d"),
    ("cc-by-nc-nd", "creativecommons org", r"creativecommons org licenses by nc nd \d \d"),
    ("cc-by-nc-sa", "creativecommons org", r"creativecommons org licenses by nc sa \d \d"),
    ("cc-by-nd", "creativecommons org", r"creativecommons org licenses by nd \d \d"),
    ("cc-by-sa", "creativecommons org", r"creativecommons org licenses by sa \d \d"),
    ("cc0-1.0", "creativecommons org", r"creativecommons org publicdomain zero 1 0"),
    ("confidential", "confidential", r"(?:proprietary and confidential|confidential and proprietary)"),
    ("gpl", "redistribute", r"this program is free software you can redistribute it and or modify"),
    ("isc", "without fee", r"permission to use copy modify and (?:or )?distribute this software for any purpose with or without fee is hereby granted"),
    ("mit", "hereby granted", r"permission is hereby granted free of charge to any person obtaining a copy"),
    ("no-copying", "reproduced", r"(?:may not be|no part of this \w+ may be) reproduced"),
    ("proprietary", "unauthorized", r"unauthorized (?:copying|reproduction|use|distribution)"),
    ("public-domain", "public domain", r"(?:in|into|to) the public domain"),
    ("reserved", "rights reserved", r"(?:some|no) rights reserved"),
    ("unlicense", "unencumbered", r"this is free and unencumbered software released into the public domain"),
    ("wtfpl", "you want to", r"do what the fuck you want to public license"),
]

# Phrases of the base, which are reported wherever their words stand.
PHRASES = [("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")]
