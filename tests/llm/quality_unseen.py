"""Texts written and checked by hand that neither rules nor trees have seen: for measuring only."""

from tests.llm.pairs_holdout import ANSWERED


def _prose() -> list[str]:
    out = []
    for i, (question, answer) in enumerate(ANSWERED):
        out.append(answer)
        words = f"{question} {answer}".split()
        if i % 3 == 0:
            out.append("\n".join(" ".join(words[k : k + 6]) for k in range(0, len(words), 6)))
        if i % 3 == 1:
            out.append(answer.lower().replace(".", "").replace(",", ""))
        if i % 4 == 0:
            out.append(f"{answer}\n\n- {words[0]}\n- {words[-1].rstrip('.')}\n\n{answer}")
    return out


PROSE = [
    *_prose(),
    "We met at the station, bought two tickets and sat down in the last carriage, where it was quiet enough to talk about the plan.",
    "Nobody had told the children that the lake was frozen only at its edges, so the teacher ran after them and called them back.",
    "Der Brief kam an einem Montag an, und weil niemand zu Hause war, lag er bis zum Abend im Regen vor der Tür.",
    "Aunque llovía desde la mañana, los pescadores salieron al mar porque el precio había subido otra vez.",
]

LIST = (
    "- hammer\n- two saws\n- box of nails\n- sandpaper\n- glue",
    "* Brot\n* Butter\n* Honig\n* ein Glas Milch\n* Obst",
    "1. Boil the water\n2. Add the tea\n3. Wait\n4. Pour",
    "a) wood\nb) stone\nc) iron\nd) glass\ne) clay",
    "Chapter 1 ........ 5\nChapter 2 ....... 19\nChapter 3 ....... 44\nIndex .......... 97",
    "[1] Brown, T. (1999). Birds of the coast. J. Ornith. 3, 11-19.\n[2] Silva, M. (2003). Winter birds. Nat. Rev. 8, 70-88.\n[3] Kern, P. (2010). Moult. Ibis 12(1), 1-9.\n[4] Doe, J. (2015). Eggs. Zool. Lett. 2, 4-6.",
    "- le pain\n- le fromage\n- deux pommes\n- une bouteille d'eau\n- du chocolat",
    "• manzanas\n• peras\n• uvas\n• una sandía\n• cerezas",
    "apple, 3, 17\napricot, 21\nbanana, 5, 60-64\ncherry, 9\ndate, 33",
    "Smith, Anna\nTaylor, Bob\nUnger, Carl\nVogel, Dora\nWagner, Emil\nXander, Flo",
    "-h, --help  show help\n-v, --version  show version\n-o FILE  output\n-q  quiet\n-n NUM  lines",
    "[x] passports\n[ ] tickets\n[ ] charger\n[x] book\n[ ] umbrella",
    "1) Vorwort\n2) Grundlagen\n3) Versuche\n4) Ergebnisse\n5) Anhang",
    "Monday\nTuesday\nWednesday\nThursday\nFriday\nSaturday",
    "i. first draft\nii. review\niii. corrections\niv. print",
    "Zutaten\n200 g Mehl\n2 Eier\n100 ml Milch\n1 Prise Salz\n30 g Butter",
    "+ Fixed crash on start\n+ Added dark theme\n+ Removed old icons\n- Dropped support for XP",
    "1.1 Scope\n1.2 Terms\n2.1 Duties\n2.2 Fees\n3.1 Notice\n3.2 Disputes",
    "Fixed: login loop (#12)\nFixed: slow search (#15)\nAdded: export (#18)\nChanged: colours (#20)",
    "Lisboa\nPorto\nBraga\nCoimbra\nFaro\nÉvora\nAveiro",
    "- [ ] call the bank\n- [ ] buy stamps\n- [x] water plants\n- [ ] mend bike",
    "Step 1: unplug\nStep 2: open lid\nStep 3: swap filter\nStep 4: close lid\nStep 5: plug in",
    "Oak\nBeech\nLime tree\nScots pine\nSilver birch\nRowan",
    "1. Eau\n2. Farine\n3. Levure\n4. Sel\n5. Sucre\n6. Huile",
    "Meier, K., Holz, R. (2001): Moore. Natur 4, 12-20.\nLang, S. (2006): Torf. Boden 9, 3-8.\nRoth, E. (2012): Seen. Limnol. 1, 5-7.\nAdler, N. (2014): Ufer. Geo 7, 1-4.",
    "· violin\n· viola\n· cello\n· double bass\n· harp",
    "Figures ........ vi\nTables ......... vii\nPreface ........ ix\n1 Sources ....... 1\n2 Methods ...... 30",
    "--color WHEN  use colours\n--depth N  levels\n--exclude PAT  skip\n--json  machine output\n--sort KEY  order",
    "1) abrir la caja\n2) sacar el cable\n3) conectar\n4) encender\n5) esperar",
    "red\ngreen\nblue\nyellow\nblack\nwhite\ngrey",
    "- Hauptstraße 4\n- Am Markt 12\n- Gartenweg 7\n- Schulgasse 1\n- Ring 33",
    "(a) rent\n(b) heating\n(c) power\n(d) water\n(e) waste",
    "abbey, 12\nabbot, 14, 80\naltar, 9-11\narch, 55\naltarpiece, 70n",
    "* v2.1 - new parser\n* v2.0 - rewrite\n* v1.9 - bug fixes\n* v1.8 - first release",
    "§ 1 Name\n§ 2 Zweck\n§ 3 Mitglieder\n§ 4 Vorstand\n§ 5 Kasse",
    "Harry Lund\nIda Moen\nJon Nes\nKari Olsen\nLars Pihl\nMona Rud",
    "- uno\n- dos\n- tres\n- cuatro\n- cinco\n- seis",
    "A. Mercury\nB. Venus\nC. Mars\nD. Saturn",
    "1. e4 opening\n2. castling\n3. forks\n4. pins\n5. endgames",
    "Rakes and hoes\nWatering cans\nSeed trays\nGarden gloves\nPlant labels\nBamboo canes",
)

TABLE = (
    "city\tarea\tpeople\nRiga\t304\t605000\nTartu\t39\t97000\nVilnius\t401\t580000\nKaunas\t157\t298000",
    "| year | sold |\n|---|---|\n| 2001 | 12 |\n| 2002 | 19 |\n| 2003 | 17 |",
    "id;name;price\n1;pen;0.8\n2;ink;3.5\n3;pad;2.2\n4;cap;9.9",
    "a,b,c\n1,2,3\n4,5,6\n7,8,9\n10,11,12",
    "<table><tr><td>x</td><td>1</td></tr><tr><td>y</td><td>2</td></tr><tr><td>z</td><td>3</td></tr></table>",
    "name=ada; age=36; city=london\nname=bob; age=41; city=leeds\nname=cyd; age=29; city=york",
    "month & rain \\\\\nJan & 44 \\\\\nFeb & 39 \\\\\nMar & 51 \\\\\nApr & 62 \\\\",
    "host      cpu     mem\nalpha     12.1    40.2\nbeta      55.0    61.7\ngamma      3.9    22.0",
    "epoch 1 | loss 2.30 | acc 0.11\nepoch 2 | loss 1.95 | acc 0.31\nepoch 3 | loss 1.60 | acc 0.44\nepoch 4 | loss 1.41 | acc 0.52",
    "team | won | lost\nReds | 7 | 2\nBlues | 5 | 4\nGreens | 1 | 8",
    "Ort\tHöhe\tJahr\nBrig\t684\t1901\nChur\t593\t1858\nThun\t560\t1859",
    "lat,lon,depth\n54.1,10.2,12\n54.3,10.9,15\n54.8,11.4,9\n55.0,11.9,22",
    "|a|b|c|\n|1|0|1|\n|0|1|1|\n|1|1|0|",
    "2021-01-01 | 17.2 | ok\n2021-01-02 | 16.9 | ok\n2021-01-03 | 18.4 | late\n2021-01-04 | 17.7 | ok",
    "gene   fold   p\nABC1   2.1    0.01\nDEF2   0.4    0.20\nGHI3   1.9    0.04\nJKL4   3.3    0.00",
    "producto;cantidad;precio\npan;3;1.2\nleche;2;0.9\nqueso;1;4.5",
    "run=1, lr=0.1, loss=2.2\nrun=2, lr=0.01, loss=1.9\nrun=3, lr=0.001, loss=2.0",
    "x\ty\n0\t1\n1\t3\n2\t5\n3\t7\n4\t9",
    "<tr><th>day</th><th>hours</th></tr><tr><td>Mon</td><td>8</td></tr><tr><td>Tue</td><td>7</td></tr><tr><td>Wed</td><td>6</td></tr>",
    "size & weight & cost \\\\\nS & 10 & 4 \\\\\nM & 14 & 5 \\\\\nL & 19 & 7 \\\\",
    "flag || meaning || type || needed\nwide || line width || int || no\nmode || how to open || str || yes\nseed || start value || int || no",
    "rank,player,points\n1,Ode,310\n2,Lam,295\n3,Fry,290\n4,Kay,288",
    "Kanton | Fläche | Ort\nUri | 1077 | Altdorf\nZug | 239 | Zug\nJura | 839 | Delsberg",
    "port    state    service\n22      open     ssh\n80      open     http\n443     open     https\n25      closed   smtp",
    "[12:00] temp=20.1 hum=40\t ok\n[12:05] temp=20.3 hum=41\t ok\n[12:10] temp=20.2 hum=41\t ok\n[12:15] temp=20.6 hum=42\t ok",
    "model,params,score\ns,7,0.61\nm,13,0.66\nl,70,0.72",
    "| Tag | Ort | Zeit |\n| Mo | Bonn | 9:00 |\n| Di | Köln | 9:30 |\n| Mi | Trier | 8:45 |",
    "isbn\tcopies\tshelf\n3001\t2\tA4\n3002\t1\tB1\n3003\t5\tC9\n3004\t1\tA2",
    "alpha; 0.2; 14\nbeta; 0.3; 18\ngamma; 0.1; 11\ndelta; 0.9; 30",
    "ville | hab.\nLyon | 520000\nNice | 340000\nBrest | 140000",
    "step: 10 | lr: 0.1 | time: 2.2\nstep: 20 | lr: 0.1 | time: 2.1\nstep: 30 | lr: 0.05 | time: 2.2",
    "depth   salt    temp\n0       34.1    12.0\n10      34.3    11.2\n20      34.6    9.8\n50      35.0    7.1",
    "q1,q2,q3,q4\n11,12,9,14\n10,15,8,13\n12,11,10,16",
    "Jan | 31 | cold\nFeb | 28 | cold\nMar | 31 | mild\nApr | 30 | mild",
    "user=1; action=open; ms=12\nuser=2; action=save; ms=40\nuser=1; action=close; ms=5\nuser=3; action=open; ms=11",
)

JUNK = (
    "Home | Login | Search | Cart | Help | Contact | Terms | Privacy | Home | Next >> | << Prev | Print",
    "click here click here click here click here click here click here click here click here click here",
    "a9 f0 3c 77 1d e2 88 0b 5a c4 19 7e d0 42 ff 6d 31 b8 05 ac 93 2f 70 e6 1b 4d c9 58 a2 0e f7 36",
    "ZXhhbXBsZSBvZiBhIGxvbmcgc3RyaW5nIHRoYXQgbWVhbnMgbm90aGluZyBhdCBhbGwgdG8gYW55b25lIHdobyByZWFkcyBpdA==",
    "#### @@@@ $$$$ %%%% ^^^^ &&&& **** (((( )))) ____ ++++ ==== {{{{ }}}} [[[[ ]]]] |||| \\\\\\\\ //// ????",
    "xkcd wqrt plmk zvbn hjgf trwq ppls kkjd mznx vbqa ggtr wwpl oiuq zzxc nnbm llkj",
    "Ã¼ber Ã¤ltere MÃ¤nner kÃ¶nnen grÃ¶Ãere HÃ¤user fÃ¼r schÃ¶ne GÃ¤ste Ã¶ffnen",
    "<div class=\"x\"><span id=a></span><script>var _q=1;function(){}</script><link rel=x></div><meta a=b>",
    "Menu\nHome\nShop\nCookies\nAccept\nClose\nMenu\nLogin\nSearch\nShare",
    "%PDF-1.5 7 0 obj <</Length 9>> stream endstream endobj 8 0 obj <</Type 1>> endobj 9 0 obj endobj",
    "Loading...\nLoading...\nLoading...\nLoading...\nLoading...\nLoading...",
    ".nav{margin:0;padding:1px}.foot{color:red}.h1{top:0;left:0}.b{float:left;width:9px}.c{z-index:2}",
    "0x00 0xff 0x1a 0x2b 0x3c 0x4d 0x5e 0x6f 0x70 0x81 0x92 0xa3 0xb4 0xc5 0xd6 0xe7 0xf8 0x09",
    "test test test test test test test test test test test test test test test test",
    "� � �� � ��� � �� � � � �� � ��� � �",
    "Share | Tweet | Pin | Mail | Print | PDF | Cite | Export | Share | Tweet | Top | Back | Next",
    "function(){var _a=[];for(;;){_a.push({x:1})}} function(b){return{c:b}} var _z={};{d:e}{f:g}",
    "buy now buy now buy now buy now buy now buy now buy now buy now buy now",
    "q8w7e6r5 t4y3u2i1 o0p9a8s7 d6f5g4h3 j2k1l0z9 x8c7v6b5 n4m3q2w1 e0r9t8y7 u6i5o4p3 a2s1d0f9 g8h7j6k5 l4z3x2c1 v0b9n8m7 q6w5e4r3 t2y1u0i9 o8p7a6s5 d4f3g2h1 j0k9l8z7 x6c5v4b3 n2m1q0w9",
    "Page 1 of 9\nPage 2 of 9\nPage 3 of 9\nPage 4 of 9\nPage 5 of 9\nPage 6 of 9\nPage 7 of 9",
    "~~~ ::: ;;; ~~~ ::: ;;; ??? !!! ~~~ ::: ;;; ??? !!! ~~~ ::: ;;; ??? !!!",
    "iVBORw0KGgoAAAANSUhEUgAAAAUAAAAFCAYAAACNbyblAAAAHElEQVQI12P4//8/w38GIAXDIBKE0DHxgljNBAAO9TXL0Y4OHwAAAABJRU5ErkJggg",
    "Skip to content Toggle navigation Home News About Contact Login Register Search Close Menu Top",
    "jkl fds uio vcx rew qaz wsx edc rfv tgb yhn ujm ikl olp zaq xsw cde vfr",
    "<span></span><span></span><div></div><div></div><script></script><style></style><iframe></iframe>",
    "ÃÂ¤ ÃÂ¶ ÃÂ¼ Ã©Ã¨ Ãª Ã« Ã® Ã¯ Ã´ Ã» Ã¹ Ã§ â€œ â€ â€™ â€“",
    "no results found\nno results found\nno results found\nno results found\nno results found",
    "Cookies Accept Reject Settings More Privacy Terms Cookies Accept Reject Settings More Privacy",
    "1f8b0800 aabbccdd 00112233 44556677 8899aabb ccddeeff 01234567 89abcdef 10203040 50607080 a1b2c3d4 e5f60718 293a4b5c 6d7e8f90 11223344 55667788 99aabbcc ddeeff00 deadbeef cafebabe",
    "{}[]();{}[]();<>{}();[]{}<>();{}[]<>();{}()[]{}();<>[]{}();",
)

UNSEEN = [*[("prose", t) for t in PROSE], *[("list", t) for t in LIST], *[("table", t) for t in TABLE], *[("junk", t) for t in JUNK]]
