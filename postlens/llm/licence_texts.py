"""Licence notices and phrases, as their publishers word them.

``PHRASES`` are the short statements whose every place counts; ``TEMPLATES``
are longer notices, and the opening passages of whole licence texts, recognised
by covered spans. Several templates may carry one label. ``SPDX`` names the
label of an identifier after ``SPDX-License-Identifier:``."""

PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to
whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission
notice shall be included in all copies or substantial portions of the Software."""

APACHE_NOTICE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless
required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing
permissions and limitations under the License."""

BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions
and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions
and the following disclaimer in the documentation and/or other materials provided with the distribution."""

BSD_3_CLAUSE = """Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
products derived from this software without specific prior written permission."""

ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies."""

GPL_NOTICE = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General
Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later
version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied
warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."""

LGPL_NOTICE = """This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General
Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later
version. This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied
warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details."""

LGPL_PROGRAM_NOTICE = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser
General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any
later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the
implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more
details."""

AGPL_NOTICE = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General
Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later
version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied
warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License for more details."""

APACHE_TEXT = """Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION,
AND DISTRIBUTION 1. Definitions. "License" shall mean the terms and conditions for use, reproduction, and distribution as
defined by Sections 1 through 9 of this document."""

GPL_TEXT = """The GNU General Public License is a free, copyleft license for software and other kinds of works. The licenses for most
software and other practical works are designed to take away your freedom to share and change the works. By contrast, the GNU
General Public License is intended to guarantee your freedom to share and change all versions of a program--to make sure it
remains free software for all its users."""

AGPL_TEXT = """The GNU Affero General Public License is a free, copyleft license for software and other kinds of works, specifically
designed to ensure cooperation with the community in the case of network server software."""

LGPL_TEXT = """This version of the GNU Lesser General Public License incorporates the terms and conditions of version 3 of the GNU
General Public License, supplemented by the additional permissions listed below."""

MPL_NOTICE = """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was
not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."""

UNLICENSE = """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify,
publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose,
commercial or non-commercial, and by any means."""

CC_BY_NOTICE = """This work is licensed under a Creative Commons Attribution 4.0 International License."""
CC_BY_SA_NOTICE = """This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."""
CC_BY_NC_NOTICE = """This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."""

CC_BY_ND_NOTICE = """This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."""
CC_BY_NC_SA_NOTICE = """This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International
License."""
CC_BY_NC_ND_NOTICE = """This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International
License."""

TEMPLATES = (
    ("agpl", AGPL_NOTICE),
    ("agpl", AGPL_TEXT),
    ("agpl", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("apache-2", APACHE_NOTICE),
    ("apache-2", APACHE_TEXT),
    ("bsd", BSD),
    ("bsd-3-clause", BSD_3_CLAUSE),
    ("cc-by", CC_BY_NOTICE),
    ("cc-by-nc", CC_BY_NC_NOTICE),
    ("cc-by-nc-nd", CC_BY_NC_ND_NOTICE),
    ("cc-by-nc-nd", "CC BY-NC-ND"),
    ("cc-by-nc-sa", CC_BY_NC_SA_NOTICE),
    ("cc-by-nc-sa", "CC BY-NC-SA"),
    ("cc-by-nd", CC_BY_ND_NOTICE),
    ("cc-by-nd", "CC BY-ND 4.0"),
    ("cc-by-sa", CC_BY_SA_NOTICE),
    ("cc-by-sa", "CC BY-SA 4.0"),
    ("gpl", GPL_NOTICE),
    ("gpl", GPL_TEXT),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "Released under the GNU General Public License, version 2."),
    ("isc", ISC),
    ("lgpl", LGPL_NOTICE),
    ("lgpl", LGPL_PROGRAM_NOTICE),
    ("lgpl", LGPL_TEXT),
    ("lgpl", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("mit", MIT),
    ("mpl-2", MPL_NOTICE),
    ("unlicense", UNLICENSE),
)

SPDX = {
    "AGPL-3.0": "agpl", "AGPL-3.0-only": "agpl", "AGPL-3.0-or-later": "agpl",
    "Apache-2.0": "apache-2",
    "BSD-2-Clause": "bsd", "BSD-3-Clause": "bsd-3-clause",
    "CC-BY-4.0": "cc-by", "CC-BY-NC-4.0": "cc-by-nc", "CC-BY-NC-ND-4.0": "cc-by-nc-nd", "CC-BY-NC-SA-4.0": "cc-by-nc-sa",
    "CC-BY-ND-4.0": "cc-by-nd", "CC-BY-SA-4.0": "cc-by-sa",
    "GPL-2.0": "gpl", "GPL-2.0-only": "gpl", "GPL-2.0-or-later": "gpl", "GPL-3.0": "gpl", "GPL-3.0-only": "gpl", "GPL-3.0-or-later": "gpl",
    "ISC": "isc",
    "LGPL-2.1": "lgpl", "LGPL-2.1-only": "lgpl", "LGPL-2.1-or-later": "lgpl", "LGPL-3.0": "lgpl", "LGPL-3.0-only": "lgpl", "LGPL-3.0-or-later": "lgpl",
    "MIT": "mit", "MPL-2.0": "mpl-2", "Unlicense": "unlicense",
}
