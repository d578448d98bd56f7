"""Templates of licenses and license notices, in the markup that ``license_scan`` compiles.

Words count, punctuation and letter case do not.  ``<<beginOptional>>...<<endOptional>>`` may be absent,
``<<var;words=a..b>>`` stands for a to b arbitrary words, ``<<var;any=x|y z>>`` for one of the wordings.
"""

from __future__ import annotations

# What the base labels stand for.
BASE_PHRASES = [("mit", "mit license"), ("apache", "apache license"), ("gpl", "general public license")]

#: How sure a match makes: the whole license or its standard header, a notice that names it, a name alone.
WHOLE, NOTICE, NAMED, RESERVED = 1.0, 0.9, 0.5, 0.25

_UNDER = "<<var;any=licensed|released|distributed|available|published>> under <<beginOptional>>the terms of<<endOptional>> " \
         "<<beginOptional>>the<<endOptional>> "
_AS_IS_BSD = """
THIS SOFTWARE IS PROVIDED BY <<var;words=1..20>> AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED
TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL
<<var;words=1..20>> BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES
(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS
INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING
NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH
DAMAGE."""
_BSD_HEAD = """
Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met: <<beginOptional>>1<<endOptional>> Redistributions of source code must retain the above
copyright notice, this list of conditions and the following disclaimer. <<beginOptional>>2<<endOptional>> Redistributions
in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the
documentation and/or other materials provided with the distribution."""

# Label, strength, template.
TEMPLATES = [
    ("MIT", WHOLE, """
<<beginOptional>>The MIT License<<endOptional>> Permission is hereby granted, free of charge, to any person obtaining a
copy of <<var;any=this software and associated documentation files|this software>> (the "Software"), to deal in the
Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute,
sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject
to the following conditions: The above copyright notice and this permission notice
<<beginOptional>>(including the next paragraph)<<endOptional>> shall be included in all copies or substantial portions
of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL
<<var;words=1..20>> BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("MIT", NOTICE, _UNDER + "<<var;any=MIT|Expat|MIT X11|MIT Expat>> license"),
    ("ISC", WHOLE, """
Permission to use, copy, modify, <<var;any=and|and or>> distribute this software for any purpose with or without fee is
hereby granted, provided that the above copyright notice and this permission notice appear in all copies."""),
    ("BSD-2-Clause", WHOLE, _BSD_HEAD + _AS_IS_BSD),
    ("BSD-3-Clause", WHOLE, _BSD_HEAD + """
<<beginOptional>>3<<endOptional>> Neither the name of <<var;words=1..20>> nor the names of its contributors may be used
to endorse or promote products derived from this software without specific prior written permission.""" + _AS_IS_BSD),
    ("BSD-3-Clause", NOTICE, _UNDER + "<<var;any=BSD 3 Clause|3 Clause BSD|Modified BSD|New BSD>> license"),
    ("BSD-2-Clause", NOTICE, _UNDER + "<<var;any=BSD 2 Clause|2 Clause BSD|Simplified BSD>> license"),
    ("Apache-2.0", WHOLE, """
Licensed under the Apache License, Version 2.0 (the "License"); you may not use <<var;any=this file|this work>> except in
compliance with the License. You may obtain a copy of the License at
<<beginOptional>><<var;any=http|https>><<endOptional>> www.apache.org/licenses/LICENSE-2.0
<<beginOptional>>html<<endOptional>><<beginOptional>>txt<<endOptional>> Unless required by applicable law or agreed to in
writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF
ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations
under the License."""),
    ("Apache-2.0", NOTICE, _UNDER + "Apache <<beginOptional>>Software<<endOptional>> License "
                                    "<<beginOptional>>Version<<endOptional>> 2.0"),
    ("GPL-2.0", NOTICE, "under <<beginOptional>>the terms of<<endOptional>> <<beginOptional>>the<<endOptional>> "
                        "<<beginOptional>>GNU<<endOptional>> General Public License "
                        "<<beginOptional>>as published by the Free Software Foundation; either<<endOptional>> "
                        "<<beginOptional>>version<<endOptional>> <<var;any=2|2.0>>"),
    ("GPL-3.0", NOTICE, "under <<beginOptional>>the terms of<<endOptional>> <<beginOptional>>the<<endOptional>> "
                        "<<beginOptional>>GNU<<endOptional>> General Public License "
                        "<<beginOptional>>as published by the Free Software Foundation; either<<endOptional>> "
                        "<<beginOptional>>version<<endOptional>> <<var;any=3|3.0>>"),
    ("GPL-3.0", WHOLE, """
This <<var;any=program|file|library|software>> is free software: you can redistribute it and/or modify it under the terms
of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at
your option) any later version. <<var;words=0..6>> is distributed in the hope that it will be useful, but WITHOUT ANY
WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General
Public License for more details."""),
    ("LGPL-2.1", NOTICE, "under the terms of the GNU Lesser General Public License <<var;words=0..12>> version 2.1"),
    ("MPL-2.0", WHOLE, """
This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
distributed with this file, You can obtain one at <<beginOptional>><<var;any=http|https>><<endOptional>>
mozilla.org/MPL/2.0"""),
    ("CC-BY-4.0", NOTICE, "licensed under <<beginOptional>>a<<endOptional>> <<var;any=CC BY|Creative Commons Attribution>> "
                          "4.0 <<beginOptional>>International<<endOptional>>"),
    ("CC-BY-SA-4.0", NOTICE, "licensed under <<beginOptional>>a<<endOptional>> "
                             "<<var;any=CC BY SA|Creative Commons Attribution ShareAlike>> 4.0"),
    ("CC-BY-NC-4.0", NOTICE, "licensed under <<beginOptional>>a<<endOptional>> "
                             "<<var;any=CC BY NC|Creative Commons Attribution NonCommercial>> 4.0"),
    ("CC0-1.0", NOTICE, "<<var;any=CC0 1.0|CC0 1.0 Universal>> Public Domain Dedication"),
    ("all-rights-reserved", RESERVED, "all rights reserved"),
]
