"""License notices and grants to look for.

--- Fixed values: public license texts, as their publishers word them ---
"""

TEMPLATES: dict[str, str] = {
    "MIT/notice": "Released under the MIT License.",
    "Apache-2.0/notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0/notice": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0/notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0/notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0/notice": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "MIT/grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions:"
    ),
    "ISC/grant": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "BSD/grant": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met:"
    ),
    "Apache-2.0/header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with "
        "the License. You may obtain a copy of the License at"
    ),
    "GPL/header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    "MPL-2.0/header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at"
    ),
    "GPL-2.0/header": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."
    ),
    "LGPL-2.1/header": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
        "License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."
    ),
    "AGPL-3.0/header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    "BSD-3-Clause/clause": (
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
        "derived from this software without specific prior written permission."
    ),
    "CC0-1.0/waiver": (
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."
    ),
    "Unlicense/dedication": "This is free and unencumbered software released into the public domain.",
    "Zlib/disclaimer": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable "
        "for any damages arising from the use of this software."
    ),
    "CC-BY-SA-4.0/short": "Licensed under CC BY-SA 4.0.",
}

#: Names of the public list of license identifiers, looked for behind its tag.
SPDX_TAG = "SPDX-License-Identifier:"
SPDX_NAMES = (
    "0BSD", "AGPL-3.0-only", "AGPL-3.0-or-later", "Apache-2.0", "Artistic-2.0", "BSD-2-Clause", "BSD-3-Clause", "BSL-1.0", "CC-BY-4.0",
    "CC-BY-SA-4.0", "CC0-1.0", "EPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later", "ISC", "LGPL-2.1-only",
    "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later", "MIT", "MPL-2.0", "Unlicense", "Zlib",
)
# --- end of fixed values ---

TEMPLATES |= {f"{name}/spdx": f"{SPDX_TAG} {name}" for name in SPDX_NAMES}

_GPL_KIN = ("lesser", "affero", "library")
_CC_KINDS = ("noncommercial", "non-commercial", "sharealike", "share-alike", "noderivatives", "no-derivatives", "noderivs")
_V2, _V3, _V4 = ("2.0", "2", "v2", "v2.0"), ("3", "3.0", "v3", "v3.0"), ("4.0", "4", "v4", "v4.0")

#: What tells a license from its kin: words it needs (one of each group), words it must not have.
DISTINCT: dict[str, tuple[tuple[tuple[str, ...], ...], tuple[str, ...]]] = {
    "MIT/notice": ((("mit",),), ()),
    "Apache-2.0/notice": ((("apache",), _V2), ()),
    "GPL-3.0/notice": ((("general",), ("public",), _V3), _GPL_KIN),
    "CC-BY-NC-4.0/notice": ((("by-nc",), _V4), ()),
    "CC-BY-4.0/notice": ((("attribution",), _V4), _CC_KINDS),
    "CC-BY-SA-4.0/notice": ((("attribution-sharealike",), _V4), _CC_KINDS),
    "Apache-2.0/header": ((("apache",), _V2), ()),
    "GPL/header": ((("general",), ("public",)), _GPL_KIN),
    "MPL-2.0/header": ((("mozilla",), _V2), ()),
    "GPL-2.0/header": ((("general",), ("public",), _V2), _GPL_KIN),
    "LGPL-2.1/header": ((("lesser",), ("2.1", "v2.1")), ()),
    "AGPL-3.0/header": ((("affero",), _V3), ()),
    "CC-BY-SA-4.0/short": ((("by-sa",), _V4), ()),
}
DISTINCT |= {f"{name}/spdx": (((SPDX_TAG.lower().rstrip(":"),), (name.lower(),)), ()) for name in SPDX_NAMES}
