"""The labelled lines that the field of ``personal`` is trained on.

Spans stand in ``<kind:...>``. In a line ``#`` is any digit, ``%`` any number to 255, ``^`` any from 256 to 999, and ``~`` the check digit
that makes the digits of its span, or of its run outside spans, pass Luhn's test; ``!`` one that makes them fail.
"""

from __future__ import annotations

LINES = [
    # written out or split addresses
    "please write to <email:anna.berg [at] example [dot] org> for details",
    "contact <email:jo.smith (at) mail.example.com> or visit us",
    "schreiben Sie an <email:info(at)beispiel.de> bis Freitag",
    "mail <email:k_meier at example dot com> now",
    "écrivez à <email:paul (arobase) exemple.fr> avant lundi",
    "escriba a <email:maria (arroba) ejemplo.es> para más datos",
    "reach me under <email:tom [at] mail [dot] example [dot] net>.",
    "<email:support[at]example.com> answers within a day",
    "my address is <email:max ## at example dot org> thanks",
    "Kontakt: <email:büro@exämple.de> oder Telefon",
    "E-Mail <email:lea {at} example {dot} com>, bitte",
    "sent by <email:r.jones @ example . com> yesterday",
    "addresse <email:luc @ exemple.fr> ou au bureau",
    "ask <email:ops##[at]mail#.example.com> about the server",
    "email <email:user## @ mail#.example.com> today",
    "the <email:webmaster AT example DOT com> account",
    "write to <email:ann.lee (at) example [dot] co [dot] uk> soon",
    "please e-mail <email:tim_ray [at] shop [dot] example [dot] com> first",
    "<email:k.o at mail dot example dot org> wrote on ## May",
    "and <email:eva dot stein at example dot de> too",
    "via <email:j-p.roux (at) exemple [point] fr> seulement",
    "correo: <email:ana.gil (arroba) ejemplo punto es>",
    # telephone numbers without a plus sign
    "call (<phone:020) #### ####> during the day",
    "call <phone:(###) ###-####> after six",
    "Tel. <phone:030/#######> von neun bis fünf",
    "Tel: <phone:0049 30 #######> erreichbar",
    "téléphone <phone:01 ## ## ## ##> le matin",
    "teléfono <phone:91 ### ## ##> por la tarde",
    "phone <phone:###-###-####> ext 12",
    "fax <phone:###.###.####> only",
    "mobile <phone:07### ######> or leave a note",
    "ring <phone:1-800-###-####> toll free",
    "reached at <phone:(###) ###-####>, he said",
    "Handy <phone:01## ########> privat",
    "tel <phone:00 1 ### ### ####> abroad",
    "numéro <phone:06.##.##.##.##> merci",
    "appelez le <phone:04 ## ## ## ##> demain",
    "llame al <phone:6## ### ###> hoy",
    "whatsapp <phone:(###)###-####> anytime",
    "phone: <phone:+ 44 20 #### ####> office",
    "Ruf an: <phone:01## #######> heute",
    "Telefon: <phone:089 / ### #####> abends",
    "call me: <phone:###-###-####>, thanks",
    "<phone:(###) ###-####> is the office",
    # cards in groups that no single blank or hyphen joins
    "card <card:4###.####.####.###~> expires soon",
    "credit card <card:5###  ####  ####  ###~> on file",
    "Karte <card:4###/####/####/###~> gültig",
    "carte <card:4### . #### . #### . ###~> valable",
    "tarjeta <card:4###_####_####_###~> válida",
    "paid with <card:37## - ###### - ####~> last week",
    "number <card:4### - #### - #### - ###~> was used",
    "visa <card:4###.####.####.###~>",
    # addresses of machines, written so that they are not links
    "from <ip:%[.]%[.]%[.]%> at noon",
    "host <ip:% . % . % . %> is down",
    "server <ip:%(.)%(.)%(.)%> replied",
    "blocked <ip:% dot % dot % dot %> again",
    "IP <ip:%[.]%.%.%> in the log",
    "Adresse <ip:%,%,%,%> gesperrt",
    "login from <ip:%-%-%-%> refused",
    # what looks like it and is not
    "card number 4###.####.####.###! is not one",
    "the number 4###############! of an order",
    "order 8############### shipped",
    "Nr. ################ im Lager",
    "serial ####-####-####-#### of the part",
    "the code is 7############### in text",
    "version #.#.# of the tool, build ####",
    "version ##.#.## was released in 20##",
    "section #.#.#.# of the manual",
    "kapitel #.#.# und #.#",
    "on 20##-0#-1# at 1#:2#:3# it ended",
    "le 1#/0#/20## à 1#h2#",
    "am 1#.0#.20## um 1#:## Uhr",
    "between 19## and 20## there were ### cases",
    "pages ###-### of volume ##",
    "ISBN 978-#-##-######-#",
    "ISBN 978#########! in print",
    "978-#-##-######-# is the book",
    "edition 979-##-###-####-# of 20##",
    "it costs $#,###.## or ##.## a month",
    "about ##,###,### people and #,### dogs",
    "the total was ###.###,## euros",
    "size ## x ## x ## cm",
    "see rows ## ## ## ## of the table",
    "values # # # # # # #",
    "1, 2, 3, 4 and 5, 6, 7, 8",
    "point ##.## dot the line",
    "he was at the station at ## past six",
    "meet at noon (at least ## of them) and go",
    "follow @user## and @name for more",
    "at example he (at last) stopped. com",
    "the dot on the map, at ##",
    "un point de plus, ## fois",
    "el punto ## de la lista",
    "Punkt ## der Liste",
    "token = \"a1b2c3d4e5f6a7b8c9d0e1f2a3b4c5d6\" is set",
    "hash 0a1b2c3d4e5f of ##",
    "address %.%.^.% is no host",
    "^.^.%.% and %.%.%",
    "line ##: error ### in file.c",
    "chapter ## verse ##",
    "id ######## of user ####",
    "id: ########## and id: ###########",
    "account ##########",
    "zip 0#### or ##### Berlin",
    "coordinates ##.####, -##.####",
    "score ##-## after ## minutes",
    "tel aviv has ###### people",
    "telephone was invented in 18##",
    "the card costs ## and the phone ###",
    "mail came at ## and left at ##",
    "email is from 19##, fax from 18##",
    "ip stands for two words in ## pages",
    "call it ## times",
]
