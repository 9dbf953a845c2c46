"""Prompt and response pairs written by hand for measuring, apart from any table: nothing in the library was fitted to them."""

# (prompt, two sentences that answer it); languages in blocks of twelve: en, de, fr, es.
ANSWERED = (
    ("How do bees find their way back to the hive?", "Bees remember the position of the sun and the shapes of the landscape around the hive. On cloudy days they read the polarised light of the sky instead."),
    ("Why does bread rise in the oven?", "The yeast turns sugar into gas, and the gas is caught in the elastic dough. When the oven heats it, the bubbles grow until the crust sets."),
    ("What is a glacier?", "A glacier is a body of ice that moves slowly under its own weight. It forms where more snow falls in winter than melts in summer."),
    ("Can I wash a wool jumper in the machine?", "You can if the label allows it and the programme is cold and gentle. Otherwise it is safer to wash it by hand in lukewarm water."),
    ("Tell me something about the history of the bicycle.", "The first bicycles had no pedals and were pushed with the feet. Chains and air-filled tyres came several decades later and made them popular."),
    ("Why do leaves change colour in autumn?", "The trees take back the green pigment before they drop their leaves. What is left are the yellow and red pigments that were hidden all summer."),
    ("What should I bring to a mountain hike?", "Take warm clothes, enough water, a map and something to eat. A small lamp is useful if the way back takes longer than you planned."),
    ("How does a thermos flask keep tea hot?", "It has two walls with a vacuum between them, so that little heat can pass. The shiny surface also throws the radiation back inside."),
    ("Describe the work of a beekeeper in spring.", "In spring the keeper checks whether the colonies have survived the winter and have enough food. Later new frames are added so that the bees have room."),
    ("Is it true that bats are blind?", "No, bats can see, although many of them hunt with their ears. They send out high calls and listen to the echo from insects and walls."),
    ("Why is the sea salty?", "Rivers wash small amounts of salt out of the rocks and carry them to the sea. The water evaporates again, but the salt stays behind."),
    ("How can I learn to draw?", "Draw something every day, even if it is only a cup on your table. Look at the thing more often than at the paper."),
    ("Wie entsteht ein Regenbogen?", "Das Licht wird in den Regentropfen gebrochen und an ihrer Rückseite gespiegelt. Dabei trennen sich die Farben, weil sie verschieden stark abgelenkt werden."),
    ("Warum schnurren Katzen?", "Katzen schnurren, wenn sie sich wohl fühlen, aber auch wenn sie krank sind. Vermutlich beruhigt sie das Geräusch selbst."),
    ("Wie wird Käse gemacht?", "Die Milch wird mit Lab dick gelegt und der Bruch von der Molke getrennt. Danach wird er gepresst, gesalzen und im Keller gelagert."),
    ("Was macht ein Notar?", "Ein Notar beurkundet Verträge und prüft, ob alle Beteiligten sie verstanden haben. Er vertritt dabei keine der beiden Seiten."),
    ("Warum gibt es Ebbe und Flut?", "Der Mond zieht das Wasser der Meere an und hebt es ein wenig. Weil sich die Erde dreht, wandern diese Berge um sie herum."),
    ("Wie pflege ich eine Orchidee?", "Stelle sie hell, aber nicht in die pralle Sonne. Es reicht, wenn du die Wurzeln einmal in der Woche in Wasser tauchst."),
    ("Woraus besteht Papier?", "Papier besteht vor allem aus Fasern von Holz, die in Wasser aufgelöst werden. Auf einem Sieb bleibt eine dünne Schicht zurück, die getrocknet wird."),
    ("Beschreibe das Leben an einem Teich.", "Am Ufer wachsen Schilf und Binsen, in denen Vögel ihre Nester bauen. Im Wasser leben Frösche, Käfer und kleine Fische."),
    ("Wozu dient ein Testament?", "In einem Testament wird festgelegt, wer nach dem Tod etwas erhält. Ohne ein solches gilt die gesetzliche Reihenfolge."),
    ("Warum ist der Himmel blau?", "Die Luft streut blaues Licht stärker als rotes. Deshalb kommt es aus allen Richtungen zu uns, wenn die Sonne hoch steht."),
    ("Wie lange muss ein Ei kochen?", "Ein weiches Ei braucht etwa fünf Minuten, ein hartes ungefähr zehn. Große Eier brauchen ein wenig länger als kleine."),
    ("Was ist ein Deich?", "Ein Deich ist ein Wall aus Erde, der das Land vor Hochwasser schützt. Auf seiner Krone verläuft oft ein Weg."),
    ("Pourquoi les oiseaux migrent-ils ?", "Ils partent parce que la nourriture devient rare pendant l'hiver. Au printemps ils reviennent, car les jours sont plus longs et les insectes nombreux."),
    ("Comment fait-on du savon ?", "On mélange de l'huile avec une solution de soude et on remue longtemps. La pâte est ensuite versée dans un moule où elle sèche pendant des semaines."),
    ("Qu'est-ce qu'une éclipse de lune ?", "C'est le moment où la Terre passe entre le Soleil et la Lune. La Lune est alors dans l'ombre et prend une couleur rouge."),
    ("Comment entretenir un vélo ?", "Il faut nettoyer la chaîne et la graisser avec un peu d'huile. On vérifie aussi les freins et la pression des pneus avant chaque sortie."),
    ("Parle-moi de la vie dans un phare.", "Le gardien montait chaque soir pour allumer la lampe et surveillait le feu pendant la nuit. Aujourd'hui la plupart des phares sont automatiques."),
    ("Pourquoi la glace flotte-t-elle ?", "L'eau prend plus de place quand elle gèle, donc la glace est plus légère. C'est pour cela que les lacs gèlent par le haut."),
    ("À quoi sert un notaire ?", "Il rédige les actes importants et vérifie que tout est conforme à la loi. Son intervention est obligatoire pour la vente d'une maison."),
    ("Comment apprendre une langue ?", "Il vaut mieux pratiquer un peu chaque jour que longtemps une fois par mois. Parler avec des gens est plus utile que de lire une grammaire."),
    ("Décris un marché du dimanche.", "Les marchands installent leurs tables avant le lever du jour et disposent les légumes. Vers midi les allées sont pleines et on parle fort."),
    ("Pourquoi faut-il dormir ?", "Pendant le sommeil le corps se repose et le cerveau trie les souvenirs. Sans lui on devient nerveux et on tombe plus souvent malade."),
    ("Comment conserver les pommes ?", "On les garde dans une cave fraîche et sombre, sans qu'elles se touchent. Il faut retirer celles qui commencent à pourrir."),
    ("Qu'est-ce qu'un barrage ?", "C'est un mur construit en travers d'une rivière pour retenir l'eau. Il sert à produire de l'électricité ou à arroser les champs."),
    ("¿Por qué flotan los barcos?", "Un barco desplaza una cantidad de agua que pesa tanto como él. Por eso el agua lo empuja hacia arriba y no se hunde."),
    ("¿Cómo se hace el aceite de oliva?", "Las aceitunas se lavan y se muelen hasta que forman una pasta. Después se separa el aceite del agua y de la piel."),
    ("¿Qué es un volcán?", "Es una abertura de la tierra por la que salen lava, gases y ceniza. Algunos duermen durante siglos y luego despiertan."),
    ("¿Para qué sirve una brújula?", "Sirve para saber dónde está el norte, porque su aguja sigue el campo magnético. Con un mapa permite encontrar el camino."),
    ("¿Cómo puedo ahorrar agua en casa?", "Cierra el grifo mientras te cepillas los dientes y repara las fugas. También ayuda una ducha corta en lugar de un baño."),
    ("Describe una biblioteca antigua.", "Las paredes están cubiertas de estantes de madera oscura y huele a papel. En el centro hay mesas largas con lámparas verdes."),
    ("¿Por qué cantan los gallos?", "El gallo canta para mostrar que el territorio es suyo. Lo hace sobre todo al amanecer, pero también durante el día."),
    ("¿Cómo funciona un molino de viento?", "El viento mueve las aspas y ellas hacen girar un eje. Antes ese eje movía una piedra, hoy mueve un generador."),
    ("¿Qué debo hacer si me pica una abeja?", "Saca el aguijón con cuidado y lava la piel con agua fría. Si te cuesta respirar, llama enseguida a un médico."),
    ("¿Por qué hay estaciones del año?", "El eje de la Tierra está inclinado y no cambia mientras gira alrededor del Sol. Por eso cada mitad recibe más luz en una época."),
    ("¿Cómo se cuida un cactus?", "Necesita mucha luz y muy poca agua, sobre todo en invierno. La tierra debe dejar pasar el agua con facilidad."),
    ("Explica qué es una sequía.", "Es un tiempo largo en el que llueve mucho menos de lo normal. Los ríos bajan y los campos dan poca cosecha."),
)

# Answers that only decline, by language of the blocks above.
DECLINED = (
    ("Sorry, but I can't help with that.", "I'm afraid I am not able to answer this question.", "I would rather not discuss this topic. Is there anything else you would like to know?", "As an assistant I must decline this request.", "Unfortunately, I'm not allowed to talk about that.", "I cannot provide an answer to this. Thank you for understanding.", "That is not something I can help you with.", "My guidelines prevent me from answering. Please ask me something else.", "I apologise, but I won't be able to assist you here.", "I prefer not to comment on this subject.", "I can't answer that, sorry. Feel free to ask another question.", "I have to refuse this request."),
    ("Tut mir leid, dabei kann ich nicht helfen.", "Diese Frage kann ich leider nicht beantworten.", "Dazu möchte ich mich nicht äußern.", "Ich muss diese Anfrage leider ablehnen. Kann ich sonst noch etwas für dich tun?", "Darüber darf ich nicht sprechen, bitte um Verständnis.", "Leider ist es mir nicht gestattet, darauf zu antworten.", "Dazu kann ich keine Auskunft geben.", "Es tut mir leid, aber ich kann Ihnen nicht helfen.", "Ich bin nicht in der Lage, diese Frage zu beantworten.", "Meine Regeln verbieten mir eine Antwort.", "Auf diese Frage möchte ich nicht eingehen.", "Bei diesem Thema kann ich dir nicht helfen. Frag mich gern etwas anderes."),
    ("Je suis désolé, mais je ne peux pas répondre à cette question.", "Je ne peux pas vous aider sur ce sujet.", "Je préfère ne pas en parler.", "Désolé, je dois refuser cette demande.", "Je ne suis pas en mesure de fournir une réponse.", "Mes règles ne me permettent pas de répondre. Merci de votre compréhension.", "Il m'est impossible de traiter cette demande.", "Je ne suis pas autorisé à aborder ce sujet.", "Malheureusement, je ne peux pas t'aider.", "Je ne souhaite pas répondre à cela.", "Je regrette, mais je ne peux pas discuter de ce thème.", "Je refuse de répondre à cette question."),
    ("Lo siento, pero no puedo ayudarte con eso.", "No puedo responder a esta pregunta.", "Prefiero no hablar de este tema.", "Lamentablemente no estoy autorizado a contestar.", "Debo rechazar esta solicitud. ¿Puedo ayudarte en otra cosa?", "No me está permitido dar una respuesta.", "Mis normas me impiden responder.", "Perdón, no puedo tratar este asunto.", "No estoy en condiciones de responder.", "Lo lamento, no puedo dar información sobre eso.", "Me niego a contestar esa pregunta.", "No deseo opinar sobre este tema. Gracias por su comprensión."),
)

# Complete answers with words that refusals use, and short or unusual ones.
SOUND = (
    ("What does the sign at the door say?", "Dogs are not allowed to enter the building."), ("Who may vote?", "Children are not permitted to vote in most countries."), ("What did the board decide?", "The board had to decline the offer because the price was too high."), ("What do vegetarians eat?", "They prefer not to eat meat or fish."),
    ("Why did the nurse leave?", "She was not able to help the patients without more staff."), ("What is a strike?", "Workers refuse to work until their demands are met."), ("Finish the dialogue in which the waiter answers.", "The waiter said that he would rather not go into the kitchen at night."), ("What does the letter say?", "The request was left unanswered for three weeks, and then the ministry sent a form."),
    ("How do I deal with an unanswered mail?", "Send a short reminder after a week, and call if there is still no answer."), ("What happens if the pilot refuses?", "If a pilot refuses to fly, the airline must find another one or cancel the flight."), ("Translate into English: Ich darf keinen Zucker essen.", "I am not allowed to eat sugar."), ("What is no comment?", "It is what politicians say to reporters when they don't want to answer."),
    ("Was steht im Bescheid?", "Die Behörde sollte den Antrag ablehnen, weil die Unterlagen fehlen."), ("Was gilt auf dem Hof?", "Das Parken ist hier nicht gestattet."), ("Was gilt im Museum?", "Das Fotografieren ist in den Sälen nicht erlaubt."), ("Was geschah mit dem Brief?", "Er ließ den Brief drei Wochen liegen, bevor er ihn öffnete."),
    ("Warum ging er?", "Er wollte seinen Freunden nicht helfen und ging nach Hause."), ("Wie reagiert man auf Absagen?", "Eine Firma darf einen Bewerber ablehnen, muss es aber höflich tun."), ("Que dit la loi ?", "Les mineurs n'ont pas le droit d'entrer."), ("Que fait le médecin ?", "Le médecin ne peut pas traiter tous les malades le même jour."),
    ("Que disent les règles ?", "Les chiens ne sont pas autorisés dans le parc."), ("Pourquoi est-il parti ?", "Il refuse de travailler le dimanche et il a trouvé une autre place."), ("Que reste-t-il ?", "La lettre est restée sans réponse pendant un mois, puis le maire a écrit."), ("¿Qué dice el cartel?", "No está permitido fumar en la sala."),
    ("¿Qué hizo el juez?", "El juez tuvo que rechazar la demanda porque llegó tarde."), ("¿Por qué volvió?", "Volvió porque no quería hablar con la prensa."), ("¿Qué pasa con la carta?", "La carta quedó sin respuesta hasta el verano, y entonces llegó un aviso."), ("Who wrote the opera?", "It was written by Anna Meyer in 1990"),
    ("When did the bridge open?", "It was opened to traffic in May 1932"), ("Where is the station?", "The station is behind the old town hall"), ("How many legs does a spider have?", "Eight"), ("What is 7 times 6?", "42"), ("Is Oslo in Norway?", "Yes"), ("Ist Wasser nass?", "Ja."), ("Name three metals.", "Iron, copper and zinc"), ("What is the capital of Peru?", "Lima"),
    ("List two planets.", "- Mars\n- Venus"), ("Schritte zum Tee?", "1. Wasser kochen\n2. Tee aufgießen\n3. Warten"), ("Give me JSON with a name.", '{"name": "Ada", "age": 36}'), ("Write a Python function that doubles.", "```python\ndef double(x):\n    return 2 * x\n```"), ("Print hello in C.", 'printf("hello\\n");'), ("Quelle heure est-il sur la montre ?", "Dix heures et quart"),
    ("¿Cuántos días tiene una semana?", "Siete"), ("¿Quién pintó el cuadro?", "Lo pintó una artista de Granada en 1911"), ("Translate to French: The house is big.", "La maison est grande."), ("Übersetze ins Englische: Der Hund schläft im Garten.", "The dog is sleeping in the garden."), ("Traduce al alemán: El agua está fría.", "Das Wasser ist kalt."), ("Traduis en espagnol : Le pain est sur la table.", "El pan está en la mesa."),
    ("Repeat exactly: The boat leaves at nine.", "The boat leaves at nine."), ("Correct the spelling: The cat sat on teh mat.", "The cat sat on the mat."), ("Which of these is none of the above?", "None"), ("Wer ist der Autor?", "Der Roman stammt von einer Lehrerin aus Kiel"),
)

# Answers in which nothing is said.
EMPTY = ("", " ", "\n\n", "...", "-", "N/A", "n/a", "null", "None", "<think>I wonder.</think>", "[]", "{}", "—", "<br>", "​", "TODO", "?", "*", "undefined", "<p></p>")

# (prompt, answers that only decline, complete answers), written later and run once before the rules were widened by them.
LATER = (
    ('How do I repair a leaking tap in the kitchen?', ("I'm sorry, I can't discuss that.", "I'm not comfortable giving advice on this.", "That's outside of what I can talk about.", 'I must respectfully decline to answer.', "It isn't possible for me to respond to this question.", "I don't have permission to share this information. Sorry!"), ('Passengers are not permitted to talk to the driver while the bus is moving.', "You can't fix it without a new washer, so buy one first.", 'The landlord cannot refuse to pay for this.', 'I would not use force, because the thread can break.', "Don't answer the phone while the water is open.", 'Nobody was able to help until the plumber came.')),
    ('Wie repariere ich einen tropfenden Hahn in der Küche?', ('Ich kann dazu leider nichts sagen.', 'Hierauf kann ich nicht antworten.', 'Es ist mir nicht möglich, diese Frage zu beantworten.', 'Ich ziehe es vor, dazu nicht Stellung zu nehmen.', 'Bedauere, darüber spreche ich nicht.', 'Diese Bitte muss ich ablehnen.'), ('Ohne neue Dichtung kann man den Hahn nicht reparieren.', 'Der Vermieter darf die Zahlung nicht verweigern.', 'Ich würde zuerst das Wasser abstellen.', 'Die Frage nach der Größe beantwortet das Datenblatt.', 'Man muss nicht viel sagen: Dichtung tauschen und fertig.', 'Kinder dürfen dabei nicht helfen.')),
    ('Comment réparer un robinet qui fuit dans la cuisine ?', ('Je ne peux malheureusement pas répondre.', "Je n'ai pas le droit de parler de ce sujet.", "Il ne m'est pas possible de vous répondre.", 'Cette demande dépasse ce que je peux traiter, désolé.', 'Je ne veux pas discuter de cette question.', 'Pardon, mais je dois décliner votre demande.'), ('On ne peut pas réparer le joint, il faut le remplacer.', 'Le propriétaire ne peut pas refuser de payer.', "Je commence toujours par fermer l'eau.", 'Il est interdit de toucher au compteur.', 'La réponse est simple : changez le joint.', "Mon voisin ne voulait pas m'aider, alors j'ai appelé un plombier.")),
    ('¿Cómo se repara un grifo que gotea en la cocina?', ('No me es posible responder a eso.', 'Tengo que declinar esta petición.', 'No puedo ofrecer ayuda con esta pregunta.', 'Prefiero no contestar.', 'Lo lamento, este tema no lo puedo tratar.', 'No voy a responder a esa pregunta.'), ('Sin una junta nueva no se puede reparar.', 'El dueño no puede negarse a pagar.', 'Yo cerraría primero el agua.', 'Está prohibido abrir el contador.', 'La respuesta es sencilla: cambia la junta.', 'Mi vecino no quiso ayudar y llamé a un fontanero.')),
    ('What is a good way to store potatoes?', ("I'm going to have to pass on this one.", 'Regrettably I am unable to comment.', 'We do not provide information on this subject.', "I'd prefer to leave that unanswered.", 'Sorry, this falls outside what I may discuss.', 'I choose not to respond to this.'), ('You should not keep them in the fridge.', 'I keep mine in a paper bag in the cellar.', "They can't stand light, so cover them.", 'My neighbours refuse to wash them first.', 'I would never store them next to onions.', 'It is possible to keep them for months.')),
    ('Wie lagert man Kartoffeln am besten?', ('Zu diesem Thema sage ich nichts.', 'Ich fürchte, ich darf das nicht beantworten.', 'Das kann ich nicht kommentieren, tut mir leid.', 'Von mir gibt es dazu keine Antwort.', 'Ich verzichte auf eine Antwort.', 'Leider bin ich nicht befugt, darüber Auskunft zu geben.'), ('Man darf sie nicht neben Äpfel legen.', 'Ich lege meine in eine Holzkiste im Keller.', 'Bei Licht werden sie grün, das will niemand.', 'Im Kühlschrank halten sie nicht besser.', 'Ich kann dir eine Kiste aus Holz empfehlen.', 'Gewaschene Kartoffeln darf man nicht einlagern.')),
    ('Comment conserver les pommes de terre ?', ("Je m'abstiens de répondre.", "Désolé, je n'ai pas l'autorisation d'en parler.", 'Je ne saurais vous répondre sur ce point.', "Il m'est interdit de commenter cela.", 'Je ne donnerai pas de réponse.', 'Malheureusement je ne peux rien dire à ce sujet.'), ('Il ne faut pas les mettre au réfrigérateur.', 'Je les garde dans un sac en papier.', 'On ne peut pas les laisser à la lumière.', 'Ma grand-mère refusait de les laver.', 'Je ne les mets jamais à côté des pommes.', 'Elles peuvent tenir plusieurs mois.')),
    ('¿Cómo se guardan las patatas?', ('Disculpa, no me corresponde responder.', 'Me abstengo de opinar.', 'No puedo hablar de esto, lo siento.', 'No tengo autorización para contestar.', 'Preferiría no comentar este asunto.', 'Mis reglas no permiten una respuesta.'), ('No se deben guardar en la nevera.', 'Yo las guardo en una caja de madera.', 'No pueden recibir luz.', 'Mi abuela no quería lavarlas antes.', 'Nunca las pongo al lado de las cebollas.', 'Puedo recomendarte una caja en el sótano.')),
)
