"""Word lists of the pair checks (fixed values, kept together).

STOPWORDS vote for the language of a text; REFUSALS decline to answer, FILLERS say nothing about the matter.
All phrases are given as the words that ``words`` makes of them: lower case, without accents or apostrophes.
"""

from __future__ import annotations

STOPWORDS = {
    "en": "the of and to in that is for with was on are as by it this be from at which or an have has not what how why does should we you your were when if than more but most will would could they their there its our been before after since because although however while given whether please describe explain write summarise tell me",
    "de": "der die das und ist nicht ein eine einen einem zu den von mit sich auf fur im dem des wird werden wurde wurden dass wir auch nach bei aus sind oder wie warum wenn weil aber zur zum zwischen ohne sollten ich kann hat als an noch nur seit durch uber was welche sodass solange bitte vergleiche nenne beschreibe erklare schreibe wer wo wohin woher woraus wozu womit wofur worin wodurch woran wann ihr du er es man diese dieser dieses mein dein sein unser",
    "fr": "le la les des et est pas un une du que qui dans pour par sur au aux ce cette il elle nous vous sont ont a ete plus ne se avec mais ou en de comment pourquoi si alors entre apres parce sans selon tant on cela depuis doit encore quand plupart l d s y quelques decris explique ecris",
    "es": "el la los las de y en que es un una por con para no se del al lo su como mas pero si o entre cuando sin sobre porque esta este entonces segun despues desde debe son fue muy tambien donde hay ya nos significa que todos cada sus por deberian conviene ocurre pocas compara describe explica escribe",
    "it": "il lo la i gli le di e che non un una per con del della dei delle nel nella al alla si sono piu ma come da su questo questa sia perche anche dopo ancora resta se tra",
    "pt": "o a os as de e que nao um uma em para com do da dos das no na se por mais mas como foi sao ao pela pelo entre sem depois ainda isso esta quando tambem porque",
    "nl": "de het een en van is niet dat in op te voor met zijn aan er door om bij naar ook als maar worden wordt deze dit wij hebben heeft nog uit over tussen omdat wanneer zonder",
}

#: Letters and signs that of these languages only one has.
LETTERS = {"de": "äöüßÄÖÜ", "fr": "çèêàùœîôÇÈÊÀ", "es": "ñ¿¡íóáúÑ"}

#: Names of languages as prompts ask for them.
LANGUAGE_NAMES = {
    "en": "english englisch englische anglais ingles inglese",
    "de": "german deutsch deutsche allemand aleman tedesco",
    "fr": "french franzosisch franzosische francais frances francese",
    "es": "spanish spanisch spanische espagnol espanol castellano spagnolo",
    "it": "italian italienisch italienische italien italiano",
    "pt": "portuguese portugiesisch portugiesische portugais portugues",
    "nl": "dutch niederlandisch niederlandische neerlandais neerlandes holandes",
    "zh": "chinese chinesisch chinesische chinois chino mandarin",
    "ru": "russian russisch russische russe ruso",
    "ja": "japanese japanisch japanische japonais japones",
    "ko": "korean koreanisch koreanische coreen coreano",
    "ar": "arabic arabisch arabische arabe",
}

TRANSLATE = ("translate", "translation", "ubersetze", "ubersetzen", "ubersetzung", "traduis", "traduire", "traduction", "traduce", "traducir", "traduccion", "traduci")

#: Words of instructions that ask for the text itself.
REPEAT = ("repeat", "copy", "correct", "proofread", "quote", "echo", "spelling", "typing", "exactly", "verbatim", "wiederhole", "wiederholen", "kopiere", "korrigiere", "ubernimm", "wortlich", "abschreiben", "repete", "repetez", "recopie", "copie", "corrige", "corriges", "repite", "copia", "corrija", "ripeti", "return", "print", "rewrite", "clean", "format")

#: Words of prompts to which none or null is an answer.
COUNTING = ("how many", "how much", "which", "wie viele", "wieviele", "welche", "welcher", "combien", "lequel", "laquelle", "lesquels", "quel", "quelle", "quels", "cuantos", "cuantas", "cuanto", "cual", "cuales", "is there any", "are there any", "null or", "none or", "or none", "or null")
NONE_WORDS = ("none", "null", "nothing", "keine", "keiner", "aucun", "aucune", "ninguno", "ninguna")

#: Answers that stand for no answer.
PLACEHOLDERS = ("n a", "na", "no answer", "answer", "assistant", "response", "reponse", "antwort", "respuesta", "none", "null", "nil", "nan", "undefined", "empty", "todo", "tbd", "placeholder", "no response", "user", "output", "keine antwort", "sans reponse", "sin respuesta", "end", "the end", "ok ok")

#: Single words of courtesy, and of the first person and of negation, which together make a sentence that says nothing of the matter.
COURTESY = frozenset("please bitte veuillez favor merci gracias thank thanks danke verstandnis comprehension understanding regrets regret sorry".split())
FIRST_PERSON = frozenset("i my me ich mir mein meine je j mon mes moi me yo mi mis tengo puedo".split())
NEGATION = frozenset("no not nothing none cannot t unable kein keine keinen nicht nichts ne n pas aucun aucune rien sin ningun ninguna nada".split())

#: Phrases that decline to answer by themselves.
REFUSALS = (
    "respectfully refuse", "respectfully decline",
    "i can t help", "i cannot help", "can not help with", "i can t assist", "i cannot assist",
    "not able to provide",
    "i can t discuss", "i cannot discuss", "i can t answer", "i cannot answer", "can t provide that", "cannot provide that",
    "i can t talk", "i cannot talk", "not a subject i can", "not a topic i can", "not something i can", "i have to decline", "i must decline",
    "guidelines prevent", "policies i work under", "against the policies", "against my policies", "against my guidelines",
    "not comfortable answering", "i will pass on", "outside what i am allowed", "beyond what i am permitted",
    "no answer about", "no answer can be given",
    "sorry no", "no opinion to offer", "no means of looking", "not going to answer", "no comment", "against my rules", "rules prevent",
    "kann ich nicht helfen", "kann ich leider nicht", "kann dir nicht helfen", "kann ihnen nicht helfen", "keine auskunft", "keine antwort geben",
    "muss ich leider ablehnen", "muss ich ablehnen", "darf ich dazu", "nicht moglich zu antworten", "dazu nichts sagen", "nicht dazu aussern", "mich nicht aussern",
    "ne peux pas vous aider", "ne peux pas t aider", "ne peux pas repondre", "ne peux pas traiter", "ne peux pas en parler", "ne peux pas discuter", "ne peux pas fournir", "impossible d en parler", "impossible de repondre", "je dois refuser", "je dois decliner", "ne permettent pas de repondre", "pas traiter cette",
    "no puedo ayudar", "no puedo responder", "no puedo tratar", "no puedo hablar", "no puedo contestar", "no puedo proporcionar", "no puedo discutir", "no puedo dar", "es imposible hablar", "imposible responder", "no permiten responder", "no quiero hablar",
)

#: Phrases that decline only if it is the speaker who won't speak of the matter, or if they say it of what was asked.
HALF_REFUSALS = (
    "unable to assist", "unable to help", "unable to fulfil", "unable to fulfill", "i am unable to", "i m unable to", "not able to answer", "not able to help", "not able to assist", "not able to respond", "not able to discuss", "not able to provide",
    "won t be able to", "will not be able to", "not in a position to", "have to refuse", "must refuse", "i decline", "i refuse", "don t feel comfortable", "do not feel comfortable", "not allowed to",
    "not permitted to", "d prefer to stay away", "would prefer to stay away", "prefer not to", "d rather not", "would rather not", "question unanswered", "request unanswered", "can t comply", "cannot comply", "can t do that", "cannot do that",
    "must leave this", "can t respond", "cannot respond", "refrain from", "rather not go into", "can t say more", "nicht beantworten", "antwort schuldig", "nicht daruber sprechen", "daruber nicht sprechen", "ablehnen", "lassen eine antwort",
    "darf ich nicht", "nicht erlaubt", "nicht gestattet", "mochte ich mich nicht", "mochte ich nicht", "nichts sagen", "unbeantwortet", "verbieten mir", "untersagen mir", "sans reponse", "m est impossible", "je refuse",
    "je decline", "prefere ne pas", "me permettent pas", "aucune reponse", "pas le droit", "m interdisent", "m interdit", "m empechent", "ne souhaite pas", "pas aborder", "ne suis pas autorise", "ne suis pas en mesure",
    "no tengo permitido", "no me esta permitido", "no estoy autorizado", "no estoy en condiciones", "debo rechazar", "tengo que rechazar", "debo declinar", "prefiero no", "sin respuesta", "no me permiten", "ninguna respuesta", "me niego",
    "me impiden", "me impide", "me prohiben", "no deseo",
)

#: Words of ability, leave and wish, which denied, and words of turning down, which as they are, decline to answer if the speaker says so of speaking.
ABLE = frozenset(
    "can cannot able could possible appropriate choose allowed permitted permission comfortable position will would going want wish prefer rather "
    "kann konnte konnen darf durfen moglich mochte will lage befugt berechtigt ziehe spreche sage antworte "
    "peux puis pouvons possible autorisation droit veux souhaite autorise mesure saurais prefere permettent permet "
    "puedo podemos posible autorizacion corresponde permiso permitido autorizado condiciones voy quiero deseo puede permiten".split()
)
TURNED_DOWN = frozenset("pass unanswered abstain verzichte enthalte abstiens abstengo decline refuse outside beyond refrain ablehnen verweigern ausserhalb refuser refuse decliner decline depasse declinar rechazar niego excede impiden impide interdit interdisent empechent verbieten untersagen prevent prevents prefiero".split())
DENYING = frozenset("not t cannot no never nichts nicht kein keine keinen keinerlei ne n pas rien aucun aucune sin ningun ninguna nada".split())
#: Words of the first person; Spanish verbs have it in them.
SPEAKER = frozenset("i me my we our ich mir mich mein meine uns wir je j m me mes moi nous yo mi mis puedo podemos tengo estoy debo prefiero preferiria deseo quiero niego voy".split())
#: Those of them that can be the subject.
SUBJECT = SPEAKER - frozenset("me my our mir mich mein meine uns m mes moi mi mis".split())
#: Words of speaking and of what is asked.
SPEAKING = frozenset(
    "speaking sharing giving offer answer answering answers help assist assisting discuss discussing talk talking say comment commenting respond responding provide share speak opinion advice information comply fulfil fulfill engage "
    "helfen weiterhelfen hilfe spreche sage antworte beantworten antworten antwort aussern auskunft sprechen sagen eingehen mitteilen kommentieren stellung "
    "repondre reponse aider parler discuter traiter aborder fournir commenter dire opinion "
    "responder respuesta ayuda ofrecer decir responderte responderle ayudar ayudarte ayudarle hablar contestar opinar tratar discutir informacion comentar".split()
)
#: Words that point to what was asked.
POINTING = frozenset("this that it dazu daruber hierzu hierauf daran darauf das cela ceci y en eso esto ello".split())
ASKED = frozenset("question request topic subject matter frage anfrage bitte thema demande sujet pregunta peticion solicitud tema asunto".split())

#: How questions begin that a few words answer.
FACTS = ("who", "when", "where", "which", "name", "list", "how many", "how much", "how old", "how long", "what year", "what time", "what is the name", "what is the capital", "print", "wer", "wann", "wo", "wie viele", "wie viel", "wie heisst", "nenne", "welche", "welcher", "welches", "qui", "quand", "combien", "quelle", "quel", "quels", "quelles", "nomme", "quien", "quienes", "cuando", "donde", "cuantos", "cuantas", "cual", "cuales", "nombra")
#: Words after which a sentence goes on.
LINKS = frozenset(
    "the a an of and or to in on at by for with from that which who as than if because but when while how why is are was were be been has have had will would can could should must not into about "
    "der die das ein eine einen einem einer und oder zu in im an am auf von vom mit fur bei aus nach dass wenn weil aber als wie ist sind war wird werden hat haben kann soll nicht "
    "le la les un une des de du et ou a au aux en dans sur par pour avec que qui si car mais quand comme est sont etait a ont peut ne "
    "el los las unos unas del y o al con por para sin que si pero cuando como es son era ha han puede no se su".split()
)

FILLERS = (
    "sorry", "i m sorry", "i am sorry", "apologies", "i apologise", "i apologize", "my apologies", "good question", "great question", "sure", "of course", "certainly", "in short", "thanks for asking", "thank you for asking", "thanks for your question", "i understand", "unfortunately", "regrettably", "to be frank",
    "is there anything else", "anything else i can", "can i help you with something else", "how else can i help", "let me know if", "please ask me something else", "feel free to ask", "happy to help with", "i hope you understand", "thanks for understanding", "thank you for understanding", "please ask", "try another", "perhaps another", "specialist", "an expert", "a professional", "something different", "something else", "another topic", "another question",
    "es tut mir leid", "tut mir leid", "entschuldigung", "leider", "bedauere", "kurz gesagt", "gern", "gerne", "gute frage", "ich bitte um verstandnis", "bitte um nachsicht", "kann ich sonst", "kann ich anders", "kann ich dir anders", "womit kann ich", "danke fur", "fachperson", "fachmann", "experten", "sonst noch etwas", "etwas anderes", "vielen dank",
    "desole", "desolee", "je suis desole", "je regrette", "en bref", "bien sur", "bonne question", "puis je vous aider", "puis je t aider", "merci de votre comprehension", "merci pour votre question", "autre chose", "specialiste", "un expert", "professionnel", "autre sujet", "autrement", "merci de",
    "lo siento", "lo lamento", "disculpa", "disculpe", "perdon", "en resumen", "claro", "buena pregunta", "hay algo mas", "puedo ayudarte en otra", "puedo ayudarle en otra", "gracias por", "otra cosa", "especialista", "un experto", "profesional", "otro tema",
)
