"""Texts by which licenses are recognised, with the label that each gives."""

#: The base phrases: found wherever their words stand one after the other.
PHRASES = [
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
]

#: Notices and whole licenses: found also where some of their words are changed.
TEXTS = [
    ("gpl-3", "licensed under the gnu general public license version 3"),
    ("gpl-2", "licensed under the gnu general public license version 2"),
    ("lgpl", "licensed under the gnu lesser general public license"),
    ("agpl-3", "licensed under the gnu affero general public license version 3"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-sa", "licensed under a creative commons attribution sharealike 4 0 international license"),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not "
              "distributed with this file you can obtain one at http mozilla org mpl 2 0"),
    ("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the "
                 "license you may obtain a copy of the license at http www apache org licenses license 2 0 unless required by "
                 "applicable law or agreed to in writing software distributed under the license is distributed on an as is basis "
                 "without warranties or conditions of any kind either express or implied see the license for the specific language "
                 "governing permissions and limitations under the license"),
    ("gpl-3", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
              "license as published by the free software foundation either version 3 of the license or at your option any later "
              "version this program is distributed in the hope that it will be useful but without any warranty without even the "
              "implied warranty of merchantability or fitness for a particular purpose see the gnu general public license for more "
              "details"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
            "documentation files the software to deal in the software without restriction including without limitation the rights "
            "to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to "
            "whom the software is furnished to do so subject to the following conditions the above copyright notice and this "
            "permission notice shall be included in all copies or substantial portions of the software the software is provided "
            "as is without warranty of any kind express or implied including but not limited to the warranties of merchantability "
            "fitness for a particular purpose and noninfringement in no event shall the authors or copyright holders be liable "
            "for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in "
            "connection with the software or the use or other dealings in the software"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted "
            "provided that the above copyright notice and this permission notice appear in all copies"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the "
            "following conditions are met redistributions of source code must retain the above copyright notice this list of "
            "conditions and the following disclaimer redistributions in binary form must reproduce the above copyright notice "
            "this list of conditions and the following disclaimer in the documentation and or other materials provided with the "
            "distribution"),
    ("unlicense", "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use "
                  "compile sell or distribute this software either in source code form or as a compiled binary for any purpose "
                  "commercial or non commercial and by any means"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable "
             "for any damages arising from the use of this software permission is granted to anyone to use this software for any "
             "purpose including commercial applications and to alter it and redistribute it freely"),
    ("all-rights-reserved", "all rights reserved no part of this publication may be reproduced without permission"),
]
