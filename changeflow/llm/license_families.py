"""Licence sentences by family and version, for ``licenses``: notices, GNU headers, SPDX tags and usual wordings."""

from __future__ import annotations

import re

# Further wordings of sentences that ``licenses`` names.
WORDINGS: dict[str, list[str]] = {
    "bsd.endorse": [
        *(f"Neither the name of the copyright holder nor the names of {whose} contributors may be used to endorse or promote "
          "products derived from this software without specific prior written permission." for whose in ("their", "any", "other")),
        # The rest of the sentence after a name like "Example Inc."
        *(f"nor the names of {whose} contributors may be used to endorse or promote products derived from this software "
          "without specific prior written permission." for whose in ("its", "their")),
        *(f"The name{s} of {who} may not be used to endorse or promote products derived from this software without specific "
          "prior written permission." for s, who in (("", "the author"), ("s", "the authors"), ("", "the copyright holder"),
                                                     ("", "the contributors"), ("s", "the contributors")))],
    "isc.grant": [
        f"Permission to use, copy, modify, {and_or} distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."
        for and_or in ("and", "and distribute, and/or")],
    "mit.title": ["The MIT License", "The MIT License (MIT)", "MIT Licence"],
}

# Licence, the names that notices give it.
NAMES: dict[str, tuple[str, ...]] = {
    "MIT": ("the MIT License", "the MIT licence", "MIT", "MIT License", "the Expat License"),
    "Apache-2.0": ("the Apache License, Version 2.0", "the Apache License Version 2.0", "the Apache License 2.0",
                   "the Apache License v2.0", "the Apache 2.0 License", "the Apache 2 License", "Apache License 2.0",
                   "Apache 2.0"),
    "Apache": ("the Apache License", "Apache License"),
    "BSD-2-Clause": ("the BSD 2-Clause License", "the 2-Clause BSD License", "the Simplified BSD License",
                     "the BSD 2-Clause \"Simplified\" License", "BSD 2-Clause"),
    "BSD-3-Clause": ("the BSD 3-Clause License", "the 3-Clause BSD License", "the New BSD License",
                     "the Modified BSD License", "the BSD 3-Clause \"New\" or \"Revised\" License", "BSD 3-Clause"),
    "BSD": ("the BSD License", "a BSD License", "a BSD-style License", "BSD", "BSD License"),
    "ISC": ("the ISC License", "ISC", "ISC License"),
    "CC0-1.0": ("CC0", "CC0 1.0", "the CC0 License", "the CC0 1.0 License", "CC0 1.0 Universal",
                "the Creative Commons CC0 1.0 Universal License", "the Creative Commons Zero v1.0 Universal License"),
    "BSL-1.0": ("the Boost Software License, Version 1.0", "the Boost Software License 1.0", "the Boost Software License"),
    "Artistic-2.0": ("the Artistic License 2.0", "the Artistic License, version 2.0"),
    "Zlib": ("the zlib License", "the zlib/libpng License", "zlib"),
    "Unlicense": ("the Unlicense", "Unlicense"),
    "WTFPL": ("the WTFPL", "WTFPL"),
}
# Licence, full name, short name, versions.
NUMBERED = (("MPL", "Mozilla Public License", "MPL", ("1.1", "2.0")), ("EPL", "Eclipse Public License", "EPL", ("1.0", "2.0")),
            ("CDDL", "Common Development and Distribution License", "CDDL", ("1.0", "1.1")),
            ("EUPL", "European Union Public Licence", "EUPL", ("1.1", "1.2")))
GNU = (("GPL", "GNU General Public License", ("1", "2", "3")), ("LGPL", "GNU Lesser General Public License", ("2.1", "3")),
       ("LGPL", "GNU Library General Public License", ("2",)), ("AGPL", "GNU Affero General Public License", ("3",)))
CC = (("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-NC", "Attribution-NonCommercial"),
      ("BY-ND", "Attribution-NoDerivatives"), ("BY-ND", "Attribution-NoDerivs"),
      ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"), ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"),
      ("BY-NC-ND", "Attribution-NonCommercial-NoDerivs"))
CC_VERSIONS = (("1.0", "Generic"), ("2.0", "Generic"), ("2.5", "Generic"), ("3.0", "Unported"), ("4.0", "International"))
# ``licenses`` brings "This work is licensed under the terms of the ..." and the like to this form.
GRANTS = tuple(f"{how} under " for how in ("licensed", "released", "distributed", "available"))


def _numbered(full: str, short: str, version: str) -> list[str]:
    """Names of a licence in one version."""
    return [f"{the}{full}{v}" for the in ("the ", "") for v in (f", version {version}", f" version {version}", f" v{version}",
                                                               f" {version}")] + [
        f"{the}{short}{v}" for the in ("", "the ") for v in (f" version {version}", f"v{version}", f" v{version}", f" {version}")]


def notice_names() -> dict[str, list[str]]:
    """licence -> names."""
    names = {k: list(v) for k, v in NAMES.items()}
    for licence, full, short, versions in NUMBERED:
        names[licence] = [f"the {full}", f"the {short}", short]
        for v in versions:
            names[f"{licence}-{v}"] = _numbered(full, short, v)
    for family, full, versions in GNU:
        names.setdefault(family, []).extend([f"the {full}", full, f"the GNU {family}", f"the {family}", family])
        for v in versions:
            whole = v if "." in v else f"{v}.0"
            forms = [x for n in dict.fromkeys((v, whole)) for short in (family, f"GNU {family}") for x in _numbered(full, short, n)]
            names.setdefault(f"{family}-{whole}-only", []).extend(forms + [f"{x} only" for x in forms])
            names.setdefault(f"{family}-{whole}-or-later", []).extend(
                f"{x}{tail}" for x in forms for tail in (" or later", " or any later version", " or (at your option) any later version"))
    for kind, full in CC:
        names.setdefault(f"CC-{kind}", []).extend(
            [f"CC {kind}", f"a Creative Commons {full} License", f"the Creative Commons {full} License"])
        for v, region in CC_VERSIONS:
            names.setdefault(f"CC-{kind}-{v}", []).extend(
                [f"CC {kind} {v}", f"the CC {kind} {v} license", f"a CC {kind} {v} license"]
                + [f"{a} Creative Commons {full} {v}{r} License" for a in ("a", "the") for r in ("", f" {region}")])
    bare = {k: [re.sub("^(?:the|an?) ", "", n) for n in v] for k, v in names.items()}
    # Names that differ in marks alone are one sentence.
    return {k: list({re.sub("[^a-z0-9]+", " ", n.lower()): n for n in v}.values()) for k, v in bare.items()}


def families() -> tuple[dict[str, list[str]], list[tuple[str, str, tuple[str, ...]]]]:
    """(sentence -> wordings, rules). Wordings of a sentence have equally many pieces."""
    sentences = {"reserved.all": ["All rights reserved.", "All rights are reserved."],
                 "reserved.some": ["Some rights reserved."],
                 "mpl.version": ["This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0.",
                                 "This Source Code Form is subject to the terms of the Mozilla Public License, v2.0."]}
    rules = [("mit-title", "MIT", ("mit.title",)), ("all-rights-reserved", "All-Rights-Reserved", ("reserved.all",)),
             ("some-rights-reserved", "Some-Rights-Reserved", ("reserved.some",)),
             ("mpl-2-header-version", "MPL-2.0", ("mpl.version",))]
    for licence, names in notice_names().items():
        low = licence.lower()
        sentences[f"notice.{low}"] = [f"{g}{n}." for g in GRANTS for n in names]
        rules.append((f"notice-{low}", licence, (f"notice.{low}",)))
        sentences[f"spdx-id.{low}"] = [f"SPDX-License-Identifier: {licence}"]
        rules.append((f"spdx-{low}", licence, (f"spdx-id.{low}",)))
    for family, full, versions in GNU:
        key = full.split()[1].lower()
        terms = f"you can redistribute it and/or modify it under the terms of the {full}"
        by = "as published by the Free Software Foundation"
        sentences[f"gnu.{key}"] = [f"{terms} {by};"]
        for v in versions:
            whole = v if "." in v else f"{v}.0"
            for tail, licence, either in ((", or (at your option) any later version.", f"{family}-{whole}-or-later", "either "),
                                          (".", f"{family}-{whole}-only", "")):
                low = f"{key}-{licence.lower()}"
                sentences[f"gnu-version.{low}"] = [f"{either}version {v} of the License{tail}"]
                sentences[f"gnu-whole.{low}"] = [f"{terms} {by}, {either}version {v} of the License{tail}"]
                rules.append((f"header-{low}", licence, (f"gnu.{key}", f"gnu-version.{low}")))
                rules.append((f"header-{low}-whole", licence, (f"gnu-whole.{low}",)))
            sentences[f"gnu-kernel.{key}-{v}"] = [
                f"{terms}{x} {by}{end}." for x, end in ((f" version {v}", ""), (f", version {v},", ""), ("", f", version {v}"),
                                                       (f" v{v}", ""))]
            rules.append((f"header-{key}-{whole}-fixed", f"{family}-{whole}-only", (f"gnu-kernel.{key}-{v}",)))
    return sentences, rules
