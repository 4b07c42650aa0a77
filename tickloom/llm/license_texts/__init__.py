"""Whole texts of licences, one file each, and the headers that the licences' own texts ask for.

All but two groups of files are copies of those of a Debian system. The short permissive ones are typed in, without names of
holders. AGPL-3.0 is GPL-3.0 with its own title, preamble and section 13.
"""

from functools import cache
from pathlib import Path

_GNU = (
    "This {what} is free software{mark} you can redistribute it and/or modify it under the terms of the GNU {name} as published by the Free Software Foundation, {version}. "
    "This {what} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. "
    "See the GNU {name} for more details. You should have received a copy of the GNU {name} along with this {what}{end}"
)
_POST = "; if not, write to the Free Software Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA."
_SITE = ". If not, see <https://www.gnu.org/licenses/>."


def _gnu(name: str, number: str, what: str = "program") -> list[str]:
    """The header for this version only and for later ones too, with the postal address and with the site."""
    versions = (f"either version {number} of the License, or (at your option) any later version", f"version {number} of the License")
    return [_GNU.format(what=what, mark=":", name=name, version=v, end=end) for v in versions for end in (_POST, _SITE)]


_CC = 'This work is licensed under the Creative Commons {} {} International License. To view a copy of this license, visit https://creativecommons.org/licenses/{}/{}/ or send a letter to Creative Commons, PO Box 1866, Mountain View, CA 94042, USA.'

#: Fixed values: (licence, header).
HEADERS = (
    *(("AGPL-3.0", t) for t in _gnu("Affero General Public License", "3")),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.'),
    ("Apache-2.0", 'Licensed to the Apache Software Foundation (ASF) under one or more contributor license agreements. See the NOTICE file distributed with this work for additional information regarding copyright ownership. The ASF licenses this file to You under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.'),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at https://www.boost.org/LICENSE_1_0.txt)"),
    ("CC-BY-4.0", _CC.format("Attribution", "4.0", "by", "4.0")),
    ("CC-BY-NC-4.0", _CC.format("Attribution-NonCommercial", "4.0", "by-nc", "4.0")),
    ("CC-BY-SA-4.0", _CC.format("Attribution-ShareAlike", "4.0", "by-sa", "4.0")),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"),
    *(("GPL-2.0", t) for t in _gnu("General Public License", "2")),
    *(("GPL-3.0", t) for t in _gnu("General Public License", "3")),
    *(("LGPL-2.0", t) for t in _gnu("Library General Public License", "2", "library")),
    *(("LGPL-2.1", t) for t in _gnu("Lesser General Public License", "2.1", "library")),
    *(("LGPL-3.0", t) for t in _gnu("Lesser General Public License", "3", "library")),
    ("MIT", "Use of this source code is governed by an MIT-style license that can be found in the LICENSE file or at https://opensource.org/licenses/MIT."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
)


@cache
def long_templates() -> tuple[tuple[str, str], ...]:
    """(licence, text) of all headers and whole texts; a licence may have several."""
    return HEADERS + tuple((f.stem, f.read_text("utf-8")) for f in sorted(Path(__file__).parent.glob("*.txt")))
