"""Texts written and labelled by hand: every second one calibrates probabilities, the others help to train kinds that a corpus hardly has."""

from __future__ import annotations

HOLDOUT: tuple[tuple[str, str], ...] = (
    ("prose", "The committee met on Tuesday and agreed to repeat the survey, because half of the answers had been lost when the server was moved."),
    ("prose", "We could not reproduce the effect. After three attempts with fresh samples the difference was smaller than the error of the scale."),
    ("prose", "however the older model is still used by most of the groups we asked since it needs less memory and nobody has time to retrain it"),
    ("prose", "When the river rises in spring, the lower\nmeadows are flooded for several weeks, so that\nthe farmers bring their cattle to the hills and\nreturn only when the grass has dried."),
    ("prose", "Die Ergebnisse zeigen, dass die neue Methode schneller ist, aber sie braucht mehr Speicher als die alte und ist deshalb nicht für jeden Rechner geeignet."),
    ("prose", "Im Winter wird das Wasser aus dem See abgelassen, damit die Mauer von innen geprüft werden kann. Das dauert ungefähr zwei Wochen."),
    ("prose", "Nous avons comparé les deux versions du texte et nous avons trouvé que la seconde était plus courte, mais qu'elle contenait les mêmes arguments."),
    ("prose", "Il ne faut pas oublier que la plupart des archives de cette période ont été détruites pendant la guerre."),
    ("prose", "Los vecinos dicen que el puente se construyó antes de la guerra, pero en los documentos del ayuntamiento no hay ninguna fecha."),
    ("prose", "Si la temperatura sube por la noche, el hielo se rompe y el barco puede salir del puerto sin ayuda."),
    ("prose", "To install the tool, download the archive and unpack it in your home folder. Then open a shell and run:\n\npip install .\n\nAfter that the command should be found. If it isn't, check that the folder is in your path."),
    ("prose", "The prices rose again last year.\n\n| year | price |\n|---|---|\n| 2019 | 12 |\n| 2020 | 14 |\n\nAs the table shows, the rise was largest in the second year, when the harvest had failed and much of the grain had to be brought in by ship."),
    ("prose", "Thanks for the report. I can see the same error here, and I think it is caused by the last change to the parser. Until it is fixed you can set the old flag."),
    ("prose", "This is a note about the meeting.\nIt was short and nobody objected to the plan.\nWe will start in May, if the money arrives in time.\nUntil then the old schedule is kept."),
    ("list", "- apples\n- two kinds of flour\n- a jar of honey\n- butter\n- salt\n- dried yeast"),
    ("list", "1. Introduction\n2. Materials\n3. Field work\n4. Results\n5. Discussion\n6. References"),
    ("list", "1 Introduction ............ 3\n2 Related work ............ 7\n2.1 Early systems .......... 8\n3 Method ................. 12\n4 Conclusion ............. 31"),
    ("list", "--verbose  print more\n--quiet  print less\n--output FILE  where to write\n--jobs N  number of workers\n--help  show this text"),
    ("list", "[1] Meyer, A., Lindt, B. (2004). On slow rivers. Water J. 12(3), 44-51.\n[2] Okoro, C. (2011). Sediment and time. Hydrol. Lett. 8, 101-119.\n[3] Duval, P., Roy, E. (1998). Crues anciennes. Rev. Geol. 40(2), 7-22."),
    ("list", "bridge, 14, 22, 108\nbuttress, 31\ncanal, 7, 45-49\ncistern, 12ff.\ndam, 3, 88\ndrain, 90"),
    ("list", "Added: search by author (#120)\nFixed: wrong page numbers (#133)\nRemoved: the old importer (#98)\nChanged: default font (#141)"),
    ("list", "* la lámpara\n* el reloj\n* las sillas\n* la mesa grande\n* los platos"),
    ("list", "die Lampe\nder Tisch\nzwei Stühle\nein Regal\ndas Fenster\nder Spiegel\neine Bank"),
    ("list", "1) le pain;\n2) le beurre;\n3) les œufs;\n4) la farine;\n5) le sel."),
    ("list", "Marta Ruiz\nHelen Osei\nJonas Falk\nPaul Duval\nIrene Ito\nOmar Said\nLin Chen"),
    ("list", "[ ] Check the valves.\n[ ] Clean the filter.\n3. Replace the seal.\n4. Write down the pressure.\nClose the lid."),
    ("table", "name\tage\tcity\nAnna\t31\tOslo\nBoris\t44\tRiga\nCleo\t29\tLyon\nDan\t52\tCork"),
    ("table", "| model | size | score |\n|---|---|---|\n| a1 | 7 | 0.42 |\n| b2 | 13 | 0.47 |\n| c3 | 34 | 0.51 |"),
    ("table", "id,x,y,z\n1,0.44,0.12,3.1\n2,0.50,0.19,2.9\n3,0.47,n/a,3.3\n4,0.52,0.22,3.0"),
    ("table", "site=north; temp=4.1; wind=12\nsite=south; temp=6.0; wind=9\nsite=east; temp=5.2; wind=-\nsite=west; temp=4.8; wind=15"),
    ("table", "year & sold & left \\\\\n1990 & 412 & 18 \\\\\n1991 & 398 & 31 \\\\\n1992 & 441 & 5 \\\\"),
    ("table", "<table><tr><td>day</td><td>rain</td></tr><tr><td>Mon</td><td>3.2</td></tr><tr><td>Tue</td><td>0.0</td></tr><tr><td>Wed</td><td>7.9</td></tr></table>"),
    ("table", " step 10/100 | time: 4.12 | loss: 2.31 | rate: 1.0E-04 |\n step 20/100 | time: 4.02 | loss: 2.11 | rate: 1.0E-04 |\n step 30/100 | time: 4.05 | loss: 1.98 | rate: 9.0E-05 |"),
    ("table", "station     depth     salinity\nA1          10.2      34.1\nA2          22.0      34.4\nB1          35.7      34.9\nB2          40.1      35.0"),
    ("table", "width || how wide the box is || int || required\nheight || how tall it is || int || required\ncolor || name of the paint || str || optional"),
    ("junk", "Home | About | Login | Help | Next >> | << Back | Share | Print | Home | Top | Help | Menu | Cookies | Privacy"),
    ("junk", "Home\nMenu\nLogin\nShare\nNext >>\nTop\nHelp\nCookies\nHome\nMenu\nExport\nPDF"),
    ("junk", "This page was left empty\nThis page was left empty\nThis page was left empty 2\nThis page was left empty\nThis page was left empty 4\nThis page was left empty"),
    ("junk", "page page page page page page page page page page page page page page page page page page page page"),
    ("junk", "7f 3a 00 1c 9d ee 41 b2 08 5f c3 77 a0 12 fe 6b 34 9c d1 e8 20 4b 7a 99 01 f3 5d c6 88 2e b4 63"),
    ("junk", "TWFuIGlzIGRpc3Rpbmd1aXNoZWQsIG5vdCBvbmx5IGJ5IGhpcyByZWFzb24sIGJ1dCBieSB0aGlzIHNpbmd1bGFyIHBhc3Npb24gZnJvbSBvdGhlciBhbmltYWxzLCB3"),
    ("junk", "@#~ }{/ ;;!= ^^&*( <>?| ~~%$ [[-_ ;:'\\ @@!# ^%~` {}{}= ||//\\ ~!@#$ %^&*("),
    ("junk", "qzx vwkp jjqrt bnmlo xcvz wrtpl kkjhg zzxq plmn vbrtw qqwz ghjk xxcvb trwq mnbz lkpq wvx zzr"),
    ("junk", "var _0x1a2b=_0x3c4d(12);.box{margin:0;padding:4}<div class=\"a\"><span id=b1>3</span></div>var _0x77=_0x9(1);.c{top:2}"),
    ("junk", "%PDF-1.4 1 0 obj <</Type 3>> endobj %PDF-1.4 2 0 obj <</Len 44>> stream 0xff 0xd8 endstream <</Root 1>>"),
    ("junk", "Ã©tÃ© Ã  la fenÃªtre Â« dÃ©jÃ  Â» Ã§a Ã¼ber Ã¤hnlich MÃ¼ller grÃ¶Ã\x9fer Â§ Â° Ã±andÃº"),
)
