"""Notices and texts by which licenses are declared."""

# The wording of each license's notices, titles and, where it is short, of its whole text.
MIT_TEXT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the
Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission
notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED,
INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT
HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE
SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
ISC_TEXT = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright
notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE
INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES
OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN
CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
BSD_HEAD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must
reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""
BSD_ENDORSE = """Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without
specific prior written permission."""
BSD_TAIL = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT,
INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA,
OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR
OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""

TEMPLATES = {
    "AGPL-3.0": ["This work is licensed under the GNU Affero General Public License, version 3.", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007", "SPDX-License-Identifier: AGPL-3.0"],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.", "Apache License Version 2.0, January 2004", "SPDX-License-Identifier: Apache-2.0"],
    "BSD-2-Clause": ["Released under the BSD 2-Clause License.", f"{BSD_HEAD} {BSD_TAIL}", "SPDX-License-Identifier: BSD-2-Clause"],
    "BSD-3-Clause": ["Released under the BSD 3-Clause License.", f"{BSD_HEAD} {BSD_ENDORSE} {BSD_TAIL}", "SPDX-License-Identifier: BSD-3-Clause"],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "Creative Commons Attribution 4.0 International", "SPDX-License-Identifier: CC-BY-4.0"],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "Creative Commons Attribution-NonCommercial 4.0 International", "SPDX-License-Identifier: CC-BY-NC-4.0"],
    "CC-BY-NC-SA-4.0": ["Licensed under CC BY-NC-SA 4.0.", "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International", "SPDX-License-Identifier: CC-BY-NC-SA-4.0"],
    "CC-BY-ND-4.0": ["Licensed under CC BY-ND 4.0.", "Creative Commons Attribution-NoDerivatives 4.0 International", "SPDX-License-Identifier: CC-BY-ND-4.0"],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "Creative Commons Attribution-ShareAlike 4.0 International", "SPDX-License-Identifier: CC-BY-SA-4.0"],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2.", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991", "SPDX-License-Identifier: GPL-2.0"],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007", "SPDX-License-Identifier: GPL-3.0"],
    "ISC": ["Released under the ISC License.", ISC_TEXT, "SPDX-License-Identifier: ISC"],
    "LGPL-2.1": ["This work is licensed under the GNU Lesser General Public License, version 2.1.", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999", "SPDX-License-Identifier: LGPL-2.1"],
    "LGPL-3.0": ["This work is licensed under the GNU Lesser General Public License, version 3.", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007", "SPDX-License-Identifier: LGPL-3.0"],
    "MIT": ["Released under the MIT License.", MIT_TEXT, "SPDX-License-Identifier: MIT"],
    "MPL-2.0": ["Licensed under the Mozilla Public License, version 2.0.", "Mozilla Public License Version 2.0", "SPDX-License-Identifier: MPL-2.0"],
    "proprietary": ["All rights reserved.", "Proprietary and confidential."],
}
