"""Stop words and suffixes per language, in natural order."""

from __future__ import annotations

STOP_WORDS: dict[str, list[str]] = {
    "en": """a about after all also an and any are as at be because been before being between both but by
        can could did do does doing down during each few for from further had has have having he her here
        hers him his how i if in into is it its itself just me more most my no nor not now of off on once
        only or other our ours out over own same she should so some such than that the their theirs them
        then there these they this those through to too under until up very was we were what when where
        which while who whom why will with would you your yours""".split(),
    "fr": """à alors au aucun aussi autre aux avec ce ces cet cette ceux chaque ci comme dans de des deux
        donc dont du elle elles en encore est et étaient était être eu eux fait font ici il ils je la le
        les leur leurs lui là ma mais me même mes moi mon ne ni nos notre nous on ont ou où par parce pas
        peu plus plutôt pour pourquoi quand que quel quelle quels qui sa sans se ses seulement si son
        sont sous sur ta te tes toi ton tous tout très tu un une vos votre vous y""".split(),
    "de": """aber alle allem allen aller alles als also am an ander andere auch auf aus bei bin bis bist da
        damit dann das dass dein deine dem den der des dich die dies diese diesem diesen dieser dieses dir
        doch dort du durch ein eine einem einen einer eines er es etwas euch euer für gegen hab habe haben
        hat hatte hatten hier hin hinter ich ihm ihn ihnen ihr ihre im in indem ins ist jede jedem jeden
        jeder jedes jener jetzt kann kein keine können man mehr mein mich mir mit muss nach nicht nichts
        noch nun nur ob oder ohne sehr sein seine sich sie sind so solche soll sondern sonst über um und
        uns unser unter viel vom von vor war waren warum was weil welche wenn wer werde werden wie wieder
        will wir wird wo zu zum zur zwar zwischen""".split(),
    "es": """a al algo algunas algunos ante antes como con contra cual cuando de del desde donde durante e
        el él ella ellas ellos en entre era erais eran eras es esa esas ese eso esos esta está estaba
        están estas este esto estos fue fueron ha había han hasta hay la las le les lo los más me mi mis
        mucho muy nada ni no nos nosotros o os otra otros para pero poco por porque que qué quien se ser
        si sí sin sobre son su sus también tanto te tiene todo todos tu tus un una uno unos y ya
        yo""".split(),
    "tr": """acaba ama ancak artık asla aslında az bana bazen bazı belki ben beni benim beş bile bir biri
        birkaç biz bizim bize bu buna bunda bundan bunu bunun burada çok çünkü da daha dahi de defa değil
        diğer diye dolayı dört en gibi göre hala halen hangi hatta hem henüz hep hepsi her herkes hiç için
        iki ile ise işte kadar karşı kendi kez ki kim mı mi mu mü nasıl ne neden nerede niçin niye o olan
        olarak oldu olduğu on ona ondan onlar onu onun ötürü öyle pek rağmen sadece sanki sen siz sonra şey
        şu şöyle tüm üç üzere var ve veya ya yani yerine yine yok zaten""".split(),
}

# Endings removed by the light stemmer when at least three letters remain.
SUFFIXES: dict[str, list[str]] = {
    "en": "ingly edly ings ing ness ment ies ed es ly s".split(),
    "fr": """issements issement ements ement ments ment ations ation itions ition euses euse eurs eur ives
        ive eaux aux ités ité ées ée és er ez es é e s""".split(),
    "de": """heiten heit keiten keit ungen ung lichen liche lich ischen ische isch erinnen ern em en er es
        e n s""".split(),
    "es": """amientos amiento imientos imiento aciones ación mente idades idad adoras adora adores ador
        iendo ando ados adas ado ada ar er ir os as es o a e s""".split(),
    "tr": """larından lerinden larının lerinin larında lerinde larına lerine larını lerini lardan lerden
        ların lerin larda lerde ları leri lara lere lar ler ından inden undan ünden ının inin unun ünün
        ında inde unda ünde ına ine una üne ını ini unu ünü nın nin nun nün dan den tan ten da de ta te
        sı si su sü ın in un ün ı i u ü a e""".split(),
}
