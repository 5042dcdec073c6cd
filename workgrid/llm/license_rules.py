"""Ordered signature rules for licence notices.

Fixed values: the families below, written by hand (label, identifiers, names,
addresses). Every family gives one rule per form it has: an identifier tag,
an address, a notice, a title and a bare name, in falling priority. All
patterns run on lower-cased lines.
"""

from __future__ import annotations

import re
from typing import NamedTuple

S = r"[ \t_-]+"  # between words
B, E = r"(?<![a-z0-9])", r"(?![a-z0-9])"  # word borders
V = r",?[ \t]*(?:\(?v(?:ersion|er|\.)?[ \t.]*)?"  # before a version number
O = r"(?:[ \t]*)"  # before a year

# The same where a notice goes on in the next line, after that line's comment marks; a version
# in the next line needs its word, as a list's number may stand there.
_NEXT = r"\r?\n[ \t#*/;%!>|-]*"
_WRAP = {
    V: rf"(?:,?[ \t]*(?:{_NEXT})?\(?v(?:ersion|er|\.)?[ \t.]*(?:{_NEXT})?|{V})",
    S: rf"(?:[ \t_-]+(?:{_NEXT})?|{_NEXT})",
    r"[ \t]+": rf"(?:[ \t]+(?:{_NEXT})?|{_NEXT})",
    O: rf"(?:[ \t]*(?:{_NEXT})?)",
}


def over_lines(pattern: str) -> str:
    """A pattern of one line as a pattern of a text in which a match may go on over line ends, but not over an empty line."""
    pattern = re.sub("|".join(map(re.escape, _WRAP)), lambda m: _WRAP[m[0]], pattern)
    if pattern.startswith("^"):
        pattern = r"(?:^|(?<=\n))" + pattern.removeprefix("^").removesuffix("$") + r"(?=\r?\n|$)"
    return pattern


class Family(NamedTuple):
    label: str
    keyword: str  # stands in every match of the name
    tag: str  # identifiers after "SPDX-License-Identifier:", empty without one
    name: str
    address: str = ""


FAMILIES = (
    Family("agpl-3.0", "affero", r"agpl-3\.0(?:-only|-or-later|\+)?", rf"(?:gnu{S})?affero{S}general{S}public{S}licen[sc]e{V}3(?:\.0)?", r"gnu\.org/licenses/agpl(?:-3\.0)?"),
    Family("gpl-3.0", "general", r"gpl-3\.0(?:-only|-or-later|\+)?", rf"(?:gnu{S})?general{S}public{S}licen[sc]e{V}3(?:\.0)?", r"gnu\.org/licenses/gpl-3\.0"),
    Family("gpl-2.0", "general", r"gpl-2\.0(?:-only|-or-later|\+)?", rf"(?:gnu{S})?general{S}public{S}licen[sc]e{V}2(?:\.0)?", r"gnu\.org/licenses/(?:old-licenses/)?gpl-2\.0"),
    Family("gpl-1.0", "general", r"gpl-1\.0(?:-only|-or-later|\+)?", rf"(?:gnu{S})?general{S}public{S}licen[sc]e{V}1(?:\.0)?", r"gnu\.org/licenses/old-licenses/gpl-1\.0"),
    Family("gpl", "general", r"gpl", rf"(?:gnu{S})?general{S}public{S}licen[sc]e", r"gnu\.org/(?:copyleft/gpl|licenses/gpl)"),
    Family("gpl-abbr", "gpl", r"gnu-gpl", rf"{B}gpl(?:{S}?v?[123](?:\.0)?)?{E}"),
    Family("lgpl-3.0", "lesser", r"lgpl-3\.0(?:-only|-or-later|\+)?", rf"(?:gnu{S})?lesser{S}general{S}public{S}licen[sc]e{V}3(?:\.0)?", r"gnu\.org/licenses/lgpl-3\.0"),
    Family("lgpl-2.1", "lesser", r"lgpl-2\.1(?:-only|-or-later|\+)?", rf"(?:gnu{S})?lesser{S}general{S}public{S}licen[sc]e{V}2\.1", r"gnu\.org/licenses/(?:old-licenses/)?lgpl-2\.1"),
    Family("lgpl-2.0", "library", r"lgpl-2\.0(?:-only|-or-later|\+)?", rf"(?:gnu{S})?library{S}general{S}public{S}licen[sc]e", r"gnu\.org/licenses/old-licenses/lgpl-2\.0"),
    Family("lgpl", "lesser", r"lgpl", rf"(?:gnu{S})?lesser{S}general{S}public{S}licen[sc]e", r"gnu\.org/licenses/lgpl"),
    Family("gfdl", "documentation", r"gfdl-1\.[123](?:-[a-z-]+)?", rf"(?:gnu{S})?free{S}documentation{S}licen[sc]e(?:{V}1\.[123])?", r"gnu\.org/(?:copyleft|licenses)/fdl"),
    Family("apache-2.0", "apache", r"apache-2\.0", rf"apache{S}(?:software{S})?licen[sc]e{V}2(?:\.0)?", r"apache\.org/licenses/license-2\.0"),
    Family("apache-1.1", "apache", r"apache-1\.1", rf"apache{S}(?:software{S})?licen[sc]e{V}1\.1", r"apache\.org/licenses/license-1\.1"),
    Family("apache-1.0", "apache", r"apache-1\.0", rf"apache{S}(?:software{S})?licen[sc]e{V}1\.0", r"apache\.org/licenses/license-1\.0"),
    Family("apache", "apache", r"apache", rf"apache{S}(?:software{S})?licen[sc]e", r"apache\.org/licenses"),
    Family("mit", "mit", r"mit", rf"{B}(?:the{S})?mit{S}(?:x11{S})?licen[sc]e", r"opensource\.org/licenses?/mit{E}"),
    Family("mit-0", "attribution", r"mit-0", rf"{B}mit{S}no{S}attribution"),
    Family("x11", "x11", r"x11", rf"{B}x11{S}licen[sc]e"),
    Family("isc", "isc", r"isc", rf"{B}isc{S}licen[sc]e", r"opensource\.org/licenses?/isc{E}"),
    Family("bsd-4-clause", "bsd", r"bsd-4-clause", rf"(?:4|four){S}clause{S}bsd|bsd{S}(?:4|four){S}clause|original{S}bsd{S}licen[sc]e"),
    Family("bsd-3-clause", "bsd", r"bsd-3-clause", rf"(?:3|three){S}clause{S}bsd|bsd{S}(?:3|three){S}clause|(?:new|revised|modified){S}bsd{S}licen[sc]e", r"opensource\.org/licenses?/bsd-3-clause"),
    Family("bsd-2-clause", "bsd", r"bsd-2-clause(?:-[a-z]+)?", rf"(?:2|two){S}clause{S}bsd|bsd{S}(?:2|two){S}clause|(?:simplified|freebsd){S}bsd{S}licen[sc]e", r"opensource\.org/licenses?/bsd-2-clause"),
    Family("0bsd", "bsd", r"0bsd", rf"zero{S}clause{S}bsd|bsd{S}(?:0|zero){S}clause"),
    Family("bsd", "bsd", r"bsd", rf"{B}bsd{S}(?:style{S})?licen[sc]e", r"opensource\.org/licenses?/bsd-license"),
    Family("mpl-2.0", "mozilla", r"mpl-2\.0(?:-no-copyleft-exception)?", rf"mozilla{S}public{S}licen[sc]e{V}2(?:\.0)?", r"mozilla\.org/mpl/2\.0"),
    Family("mpl-1.1", "mozilla", r"mpl-1\.1", rf"mozilla{S}public{S}licen[sc]e{V}1\.1", r"mozilla\.org/mpl/(?:mpl-)?1\.1"),
    Family("mpl", "mozilla", r"mpl", rf"mozilla{S}public{S}licen[sc]e", r"mozilla\.org/mpl"),
    Family("epl-2.0", "eclipse", r"epl-2\.0", rf"eclipse{S}public{S}licen[sc]e{V}2(?:\.0)?", r"eclipse\.org/legal/epl-2\.0"),
    Family("epl-1.0", "eclipse", r"epl-1\.0", rf"eclipse{S}public{S}licen[sc]e{V}1(?:\.0)?", r"eclipse\.org/legal/epl-v10"),
    Family("epl", "eclipse", r"epl", rf"eclipse{S}public{S}licen[sc]e"),
    Family("cddl-1.1", "distribution", r"cddl-1\.1", rf"common{S}development{S}and{S}distribution{S}licen[sc]e{V}1\.1"),
    Family("cddl-1.0", "distribution", r"cddl-1\.0", rf"common{S}development{S}and{S}distribution{S}licen[sc]e", r"opensource\.org/licenses?/cddl1"),
    Family("cpl-1.0", "common", r"cpl-1\.0", rf"common{S}public{S}licen[sc]e(?:{V}1\.0)?"),
    Family("eupl-1.2", "european", r"eupl-1\.2", rf"european{S}union{S}public{S}licen[sc]e{V}1\.2", r"joinup\.ec\.europa\.eu/.{0,40}eupl"),
    Family("eupl", "european", r"eupl-1\.[01]", rf"european{S}union{S}public{S}licen[sc]e"),
    Family("artistic-2.0", "artistic", r"artistic-2\.0", rf"artistic{S}licen[sc]e{V}2(?:\.0)?", r"opensource\.org/licenses?/artistic-license-2\.0"),
    Family("artistic", "artistic", r"artistic-1\.0(?:-[a-z0-9]+)?", rf"artistic{S}licen[sc]e", r"opensource\.org/licenses?/artistic"),
    Family("bsl-1.0", "boost", r"bsl-1\.0", rf"boost{S}software{S}licen[sc]e(?:{V}1\.0)?", r"boost\.org/license_1_0"),
    Family("zlib", "zlib", r"zlib", rf"zlib(?:/libpng)?{S}licen[sc]e", r"opensource\.org/licenses?/zlib"),
    Family("unlicense", "unlicense", r"unlicense", rf"{B}the[ \t]+unlicense{E}", r"unlicense\.org"),
    Family("wtfpl", "wtf", r"wtfpl", rf"{B}wtfpl{E}", r"wtfpl\.net"),
    Family("postgresql", "postgresql", r"postgresql", rf"postgresql{S}licen[sc]e"),
    Family("python-2.0", "python", r"(?:python|psf)-2\.0(?:\.[0-9])?", rf"python{S}software{S}foundation{S}licen[sc]e"),
    Family("php-3.01", "php", r"php-3\.0?1?", rf"{B}php{S}licen[sc]e(?:{V}3\.0?1?)?", r"php\.net/license"),
    Family("ofl-1.1", "font", r"ofl-1\.1(?:-[a-z-]+)?", rf"(?:sil{S})?open{S}font{S}licen[sc]e(?:{V}1\.1)?", r"scripts\.sil\.org/ofl"),
    Family("odbl-1.0", "database", r"odbl-1\.0", rf"open{S}(?:data{S}commons{S}open{S})?database{S}licen[sc]e", r"opendatacommons\.org/licenses/odbl"),
    Family("odc-by", "attribution", r"odc-by-1\.0", rf"open{S}data{S}commons{S}attribution{S}licen[sc]e", r"opendatacommons\.org/licenses/by"),
    Family("pddl-1.0", "domain", r"pddl-1\.0", rf"public{S}domain{S}dedication{S}and{S}licen[sc]e", r"opendatacommons\.org/licenses/pddl"),
    Family("cc0-1.0", "cc0", r"cc0-1\.0", rf"{B}cc0(?:[ \t-]*1\.0)?{E}", r"creativecommons\.org/publicdomain/zero"),
    Family("cc0-1.0", "commons", r"cc-zero", rf"creative{S}commons{S}zero"),
    Family("cc-by-nc-nd", "nc", r"cc-by-nc-nd-[1-4]\.[05]", rf"{B}cc{S}by{S}nc{S}nd(?:{S}[1-4]\.[05])?", r"creativecommons\.org/licenses/by-nc-nd"),
    Family("cc-by-nc-sa", "nc", r"cc-by-nc-sa-[1-4]\.[05]", rf"{B}cc{S}by{S}nc{S}sa(?:{S}[1-4]\.[05])?", r"creativecommons\.org/licenses/by-nc-sa"),
    Family("cc-by-nc", "nc", r"cc-by-nc-[1-4]\.[05]", rf"{B}cc{S}by{S}nc(?:{S}[1-4]\.[05])?", r"creativecommons\.org/licenses/by-nc/"),
    Family("cc-by-nd", "nd", r"cc-by-nd-[1-4]\.[05]", rf"{B}cc{S}by{S}nd(?:{S}[1-4]\.[05])?", r"creativecommons\.org/licenses/by-nd"),
    Family("cc-by-sa", "sa", r"cc-by-sa-[1-4]\.[05]", rf"{B}cc{S}by{S}sa(?:{S}[1-4]\.[05])?", r"creativecommons\.org/licenses/by-sa"),
    Family("cc-by-sa", "alike", r"cc-sharealike", rf"attribution{S}share{S}?alike"),
    Family("cc-by", "by", r"cc-by-[1-4]\.[05]", rf"{B}cc{S}by(?:{S}[1-4]\.[05])?{E}", r"creativecommons\.org/licenses/by/"),
    Family("creative-commons", "creative", r"cc", rf"creative{S}commons{S}(?:attribution|licen[sc]e)", r"creativecommons\.org"),
    Family("ms-pl", "microsoft", r"ms-pl", rf"microsoft{S}public{S}licen[sc]e"),
    Family("ms-rl", "microsoft", r"ms-rl", rf"microsoft{S}reciprocal{S}licen[sc]e"),
    Family("afl-3.0", "academic", r"afl-3\.0", rf"academic{S}free{S}licen[sc]e"),
    Family("osl-3.0", "open", r"osl-3\.0", rf"open{S}software{S}licen[sc]e"),
    Family("sspl-1.0", "server", r"sspl-1\.0", rf"server{S}side{S}public{S}licen[sc]e"),
    Family("busl-1.1", "business", r"busl-1\.1", rf"business{S}source{S}licen[sc]e"),
    Family("elastic-2.0", "elastic", r"elastic-2\.0", rf"elastic{S}licen[sc]e"),
    Family("openssl", "openssl", r"openssl", rf"openssl{S}licen[sc]e"),
    Family("ncsa", "illinois", r"ncsa", rf"university{S}of{S}illinois(?:/ncsa)?{S}open{S}source{S}licen[sc]e"),
    Family("vim", "vim", r"vim", rf"{B}vim{S}licen[sc]e"),
    Family("ruby", "ruby", r"ruby", rf"{B}ruby{S}licen[sc]e"),
    Family("public-domain", "public", r"public-domain", rf"(?:in|into|to){S}the{S}public{S}domain|public{S}domain{S}(?:work|dedication)"),
    Family("proprietary", "rights", r"licenseref-proprietary", rf"all{S}rights{S}reserved"),
    Family("copyright", "copyright", r"licenseref-copyright", rf"copyright{O}(?:\(c\)|©)?{O}(?:19|20)[0-9]{{2}}"),
    Family("copyright", "(c)", "", rf"\(c\){O}(?:\(c\)|©)?{O}(?:19|20)[0-9]{{2}}"),
    Family("copyright", "©", "", rf"©{O}(?:\(c\)|©)?{O}(?:19|20)[0-9]{{2}}"),
    Family("redistribution", "redistribut", r"licenseref-redistribution", rf"redistribution{S}and{S}use{S}in{S}source{S}and{S}binary{S}forms"),
    Family("permission", "permission", r"licenseref-permission", rf"permission{S}is{S}hereby{S}granted,?[ \t]+free{S}of{S}charge"),
    Family("no-warranty", "warrant", r"licenseref-no-warranty", rf"provided[ \t]+[\"']?as{S}is[\"']?,?[ \t]+without{S}warrant(?:y|ies)"),
)

#: Priority of a form: a more exact form wins where detections are nested.
PRIORITY = {"tag": 95, "address": 90, "notice": 80, "title": 70, "name": 60}


class Rule(NamedTuple):
    number: int
    label: str
    priority: int
    keyword: str
    pattern: str


def rules() -> list[Rule]:
    """All rules in their order: forms by priority, families in the order above."""
    out: list[Rule] = []

    def add(label: str, form: str, keyword: str, pattern: str) -> None:
        out.append(Rule(len(out), label, PRIORITY[form], keyword, pattern))

    for f in filter(lambda f: f.tag, FAMILIES):
        add(f.label, "tag", "spdx-license-identifier", rf"spdx-license-identifier:?[ \t]*{f.tag}(?![a-z0-9.+-])")
    for f in FAMILIES:
        if f.address:
            add(f.label, "address", f.address.split("/")[0].replace("\\", ""), rf"(?:https?://)?(?:www\.)?{f.address}")
    for f in FAMILIES:
        add(f.label, "notice", f.keyword, rf"(?:licen[sc]ed|released|distributed|available|published){S}under{S}(?:the{S})?(?:terms{S}of{S}(?:the{S})?)?(?:{f.name})")
    for f in FAMILIES:
        add(f.label, "title", f.keyword, rf"^[ \t#*/]*(?:the{S})?(?:{f.name})[ \t.]*$")
    for f in FAMILIES:
        add(f.label, "name", f.keyword, f.name)
    return out
