"""Labelled spans to learn from: sentences of intake notes, made by a context-free grammar.

No table holds labelled spans, so they are generated. The grammar composes a sentence of constituents
(who, what was done, where to, which number), so that no sentence is stored as such; slots are filled
with random names, numbers, addresses and dates in many spellings; ``plain`` sentences only look as if
they held some. The labels are right by construction. Any number can be made from a seed.

``rules`` may replace the grammar: the accuracy test reads sentences of another one.
"""

from __future__ import annotations

import random
import re

_SLOT = re.compile(r"\{((?:name|given|family|any|comma|lower|caps|id|ssn|policy|mrn|dni|chart|email|phone|address|dob|date|drug|Drug|ill|eponym|body|test|sym|lab|dose|year|month)|[nx]\d)\}")
_CHOICE = re.compile(r"\{([^{}]*)\}")
_PART = re.compile(r"(<[a-z0-9]+>|«\w+»)")
KINDS = ("email", "phone", "id", "address", "name", "dob", "date")
_ON = "b br c cl cr d dr f fl fr g gl gr h j k kl kr l m n p pl pr qu r s sh sl st str t th tr v w wr y z zw".split()
_VOWEL = "a e i o u y a e i o ae eo ia io ea é á ü ö".split()
_CODA = ["", "", "", "", "n", "l", "r", "s", "x", "nd", "rn", "th", "ll", "m", "ck"]
_GIVEN_END = "us ie ette a en is o yn ah ia el on ard ine illa".split()
_FAMILY_END = "sen ell ow ard ley ick ane ova er oro er ndez ini son berg mann ski oux".split()
_DRUG_END = "zol mab trel tin oxan adine ol ine itrel pril sone mycin xan".split()
_ILL_END = "itis oma emia osis opathy algia".split()
_SIGN_END = "stad ling mar holt wick berg".split()
_PLACE_END = "stow ville port dale heim ford ton burg".split()
_STREET_END = "brook ham wood field gate more ridge hurst".split()
_MONTHS = "January February March April May June July August September October November December".split()
_BODY = "scalp|left knee|right ankle|neck|lumbar spine|chest wall|left lung|right shoulder|lower abdomen|forearm|thumb|left hip|upper arm|right eye".split("|")
_TEST = "plain film|chest CT|echo|stress test|skin biopsy|cast change|wound check|spirometry|endoscopy|hearing test|joint tap|ultrasound".split("|")
_SYMPTOM = "cough|fever|dizziness|back pain|shortness of breath|dry mouth|night sweats|fatigue|tremor|headache|itching|poor sleep|loss of appetite|ankle swelling|palpitations|joint stiffness|wheezing|nausea".split("|")
_LAB = "bilirubin|serum sodium|hemoglobin|albumin|white count|ferritin|creatinine|fasting glucose|platelets|potassium".split("|")


class Maker:
    def __init__(self, seed: int, rules: str | None = None):
        self.r = random.Random(seed)
        self.rules = grammar(RULES if rules is None else rules)

    def one(self, of):
        return self.r.choice(of)

    def stem(self, least: int = 1, most: int = 3) -> str:
        r = self.r
        return "".join(self.one(_ON) + (self.one(_VOWEL[:14]) if r.random() < 0.985 else self.one(_VOWEL)) for _ in range(r.randint(least, most))) + (self.one(_CODA) if r.random() < 0.3 else "")

    def given(self) -> str:
        return (self.stem(1, 2) + (self.one(_GIVEN_END) if self.r.random() < 0.85 else "")).capitalize()

    def family(self) -> str:
        r = self.r.random()
        f = (self.stem(1, 2) + (self.one(_FAMILY_END) if self.r.random() < 0.9 else "")).capitalize()
        if r < 0.04:
            return "Mc" + f
        if r < 0.13:
            return f + "-" + self.one(["", "", "", "de la ", "van "]) + (self.stem(1, 2) + self.one(_FAMILY_END)).capitalize()
        if r < 0.21:
            return self.one(["de la ", "de la ", "van ", "van ", "von ", "di ", "van der ", "O'"]) + f
        return f

    def full(self) -> str:
        r = self.r.random()
        if r < 0.62:
            return f"{self.given()} {self.family()}"
        if r < 0.9:
            return f"{self.given()} {self.one('ABCDEFGHJKLMNPRSTW')}. {self.family()}"
        return f"{self.one('ABCDEFGHJKLMNPRSTW')}. {self.family()}"

    def drug(self) -> str:
        return self.stem(1, 3) + self.one(_DRUG_END)

    def ill(self) -> str:
        return self.one([f"{self.eponym()} {self.one(['disease', 'syndrome', 'fever', 'sign'])}", self.one(["acute ", "chronic ", "focal ", "mild ", "early ", "left-sided ", "diffuse ", ""]) + self.stem(1, 3) + self.one(_ILL_END)])

    def eponym(self) -> str:
        return (self.stem(1, 2) + self.one(_SIGN_END)).capitalize()

    def d(self, n: int) -> str:
        return "".join(self.one("0123456789") for _ in range(n))

    def email(self) -> str:
        r = self.r
        a, b = self.stem(1, 3), self.stem(1, 3)
        if r.random() < 0.6:
            a, b = self.family().lower().replace(" ", "").replace("'", ""), self.given().lower()
            if r.random() < 0.5:
                a, b = b, a
        user = self.one([f"{a}.{b}", f"{a}_{b}", f"{a}-{b}", f"{b[0]}{a}{self.d(2)}", f"{a}+{self.one(['chart', 'chart', 'home', 'mail'])}", a, f"{a}{b}", f"{a}{self.d(r.randint(1, 4))}"])
        host, tail = self.one(["mail", "post", "clinic", "inbox", "ward", self.stem(1, 2), "web.mail"]), self.one(["example", "test", "invalid", "example.org", "example.net", "example.com", "org", "com", "net"])
        at, dot = self.one([("@", "."), ("@", "."), ("@", "."), ("[at]", "[dot]"), ("(at)", "."), (" at ", " dot "), (" at ", " dot "), (" @ ", "."), (" @ ", "."), ("[at]", "[dot]"), (" [at] ", " [dot] "), ("(at)", "(dot)"), (" (at) ", " (dot) "), (" at ", ".")])
        out = user + at + f"{host}.{tail}".replace(".", dot)
        return out.upper() if r.random() < 0.15 and "@" in out else out

    def phone(self) -> str:
        d = self.d
        a, n = self.one("23456789") + d(2), d(4)
        mid = "555" if self.r.random() < 0.8 else d(3)
        p = self.one([f"{a}-{mid}-{n}", f"{a} {mid} {n}", f"({a}) {mid}-{n}", f"{a}.{mid}.{n}", f"{a}/{mid}-{n}", f"+1 {a} {mid} {n}", f"+1{a}{mid}{n}", f"{mid}-{n}", f"+44 20 7946 0{d(3)}", f"07700 900{d(3)}", f"00 49 30 {d(2)} {mid} {n}", f"+49 30 {d(3)} {n}", f"+1-{a}-{mid}-{n}", f"+1 ({a}) {mid}-{n}", f"0049 30 {d(4)} {n}"])
        return p + (self.one([" ext. ", " ext ", " x"]) + d(2) if self.r.random() < 0.12 else "")

    def ssn(self) -> str:
        a, b, c = "9" * (self.r.random() < 0.7) + self.d(3), self.d(2), self.d(4)
        s = self.one(["-", " ", ""])
        return f"{a[:3]}{s}{b}{s}{c}"

    def policy(self) -> str:
        s = self.one(["", " ", " "])
        return self.one("XYZABK") + s.join([self.d(3), self.d(3), self.d(3)])

    def mrn(self) -> str:
        return self.one(["MRN-", "MRN-", "MRN", "HN-", "PT-"]) + self.d(self.r.randint(6, 8))

    def dni(self) -> str:
        return self.d(8) + self.one(["-", "-", ""]) + self.one("RYTWAGMFPDXBNJZSQVHLCKE")

    def address(self) -> str:
        r, d = self.r, self.d
        street = (self.stem(1, 2) + self.one(_STREET_END)).capitalize()
        place = (self.stem(1, 3) + self.one(_PLACE_END)).capitalize()
        code = "0" * (r.random() < 0.7) + d(5)
        x = r.random()
        if x < 0.1:
            out = self.one(["P.O. Box ", "PO Box ", "P.O. box "]) + d(r.randint(3, 4))
            return out + self.one(["", f", {place}", f", {place} {code[:5]}"])
        if x < 0.18:
            return self.one([f"{street}{self.one(['straße', 'weg', 'gasse', 'allee', 'platz'])} {r.randint(1, 140)}, {code[:5]} {place}", f"{street}{self.one(['straße', 'weg', 'gasse'])} {r.randint(1, 140)}"])
        if x < 0.25:
            return f"{self.one(['Calle', 'Avenida', 'Av.', 'Calle de', 'Plaza', 'Paseo'])} {street} {r.randint(1, 140)}" + self.one(["", f", {place}", f", {place}"])
        kind = self.one(["Lane", "Street", "Road", "Court", "Ave", "Blvd.", "Rd.", "St.", "Avenue", "Drive", "Way"])
        out = f"{r.randint(1, 1999)} {street} {kind}"
        unit = self.one(["", "", f", Apt {r.randint(1, 60)}", f" #{r.randint(1, 60)}", f", Unit {r.randint(1, 60)}", f", Apt. {r.randint(1, 60)}", f", Suite {r.randint(1, 60)}"])
        return out + unit + self.one(["", f", {place}", f", {place}", f", {place} {code[:5]}"])

    def day(self) -> str:
        r = self.r
        y, m, d = r.randint(1925, 2024), r.randint(1, 12), r.randint(1, 28)
        name = _MONTHS[m - 1]
        return self.one([f"{m}/{d}/{y}", f"{m:02d}/{d:02d}/{y}", f"{d:02d}.{m:02d}.{y}", f"{d}.{m}.{y}", f"{y}-{m:02d}-{d:02d}", f"{d:02d}-{name[:3].upper()}-{y}", f"{name} {d}, {y}", f"{name[:3]} {d}, {y}", f"{d} {name} {y}", f"{d} {name[:3]} {y}", f"{name[:3]}. {d}, {y}"])

    def fill(self, slot: str) -> tuple[str, str | None]:
        r, one = self.r, self.one
        match slot:
            case "name":
                return self.full(), "name"
            case "given":
                return self.given(), "name"
            case "family":
                return self.family(), "name"
            case "any":
                return one([self.full, self.full, self.family, self.given])(), "name"
            case "comma":
                return f"{self.family()}, {self.given()}" + (f" {one('ABCDEJKLM')}." if r.random() < 0.15 else ""), "name"
            case "lower":
                return one([self.family, self.family, self.full])().lower(), "name"
            case "caps":
                return one([f"{self.family()} {self.given()}", self.full(), f"{self.family()}, {self.given()}"]).upper(), "name"
            case "id":
                return one([self.ssn, self.policy, self.dni, lambda: self.d(r.randint(6, 9))])(), "id"
            case "ssn" | "policy" | "mrn" | "dni":
                return getattr(self, slot)(), "id"
            case "chart":
                return one([self.d(r.randint(6, 8)), self.d(r.randint(6, 8)), f"{self.d(3)}-{self.d(2)}-{self.d(3)}", f"{self.d(2)}-{self.d(2)}-{self.d(2)}", f"{self.d(4)}-{self.d(4)}", f"{self.d(3)} {self.d(2)} {self.d(3)}"]), "id"
            case "email" | "phone" | "address":
                return getattr(self, slot)(), slot
            case "dob":
                return self.day(), "dob"
            case "date":
                return self.day(), "date"
            case "drug":
                return self.drug(), None
            case "Drug":
                return self.drug().capitalize(), None
            case "ill" | "eponym":
                return getattr(self, slot)(), None
            case "body":
                return one(_BODY), None
            case "test":
                return one(_TEST), None
            case "sym":
                return one(_SYMPTOM), None
            case "lab":
                return one([*_LAB, self.stem(1, 2) + "in index", self.stem(1, 2) + "ase"]), None
            case "dose":
                return one([f"{r.randint(1, 9)} mg", f"1,{r.randint(1, 9)}00 mg", f"{r.randint(1, 9)}.5 mg", f"0.{r.randint(1, 9)} mL", f"{r.randint(1, 9)} units", f"{r.randint(1, 9)} mcg"]), None
            case "year":
                return str(r.randint(1985, 2023)), None
            case "month":
                return one(_MONTHS) if r.random() < 0.5 else one(_MONTHS)[:3], None
        if slot[0] == "n" and slot[1:].isdigit():
            return str(r.randint(1, 10 ** int(slot[1:]) - 1)), None
        if slot[0] == "x" and slot[1:].isdigit():
            return self.d(int(slot[1:])), None
        return one(slot.split("/")), None

    def expand(self, rule: str, out: list[tuple[str, str | None]]) -> None:
        chosen = self.one(self.rules[rule])
        while "{" in chosen:
            chosen = _CHOICE.sub(lambda m: self.one(m[1].split("/")), chosen)
        for k, part in enumerate(_PART.split(chosen)):
            if k % 2 == 0:
                out.append((part, None))
            elif part[0] == "<":
                self.expand(part[1:-1], out)
            else:
                out.append(self.fill(part[1:-1]))

    def sentence(self, rule: str) -> tuple[str, list[tuple[int, int, str]]]:
        out, spans, size = [], [], 0
        pieces: list[tuple[str, str | None]] = []
        self.expand(rule, pieces)
        for text, kind in pieces:
            if kind:
                spans.append((size, size + len(text), kind))
            elif not size and text[:1].islower() and self.r.random() < 0.8:
                text = text[:1].upper() + text[1:]
            out.append(text)
            size += len(text)
        return "".join(out), spans

    def text(self) -> tuple[str, list[tuple[int, int, str]]]:
        """One to four sentences with their spans."""
        out, spans, size = [], [], 0
        for k in range(self.one([1, 1, 1, 2, 2, 3, 4])):
            s, found = self.sentence("holding" if self.r.random() < 0.66 else "plain")
            s = s.rstrip()
            if s[-1] not in ".!?":
                s += "." if self.r.random() < 0.75 else ""
            elif s[-1] == "." and found and found[-1][1] == len(s) and self.r.random() < 0.6:
                s += "."
            gap = self.one([" ", " ", " ", "\n", "  "]) if k else ""
            size += len(gap)
            spans += [(a + size, b + size, kind) for a, b, kind in found]
            out += [gap, s]
            size += len(s)
        return "".join(out), spans


def grammar(rules: str) -> dict[str, list[str]]:
    """``name: one | other`` lines; a line that begins with a bar goes on with the rule above. ``0`` is the empty alternative."""
    out: dict[str, list[str]] = {}
    name = ""
    for line in rules.strip().split("\n"):
        if not line.startswith("|"):
            name, _, line = line.partition(": ")
            out[name] = []
        line = _SLOT.sub(r"«\1»", line)
        out[name] += ["" if x.strip() == "0" else x.strip("~") for x in (y.strip() for y in line.strip("| ").split(" | "))]
    return out


# A tilde keeps the white space beside it. Slots in braces are filled at random, names in angles are rules.
RULES = """
holding: <who> <did> | <who> <did> | <who> <did>, then <did> | <when> <who> <did> | <when> <who> <did> | <when> <bare> <did> | <bare> <did> | <bare> <did> <at>
| <thing> <was> <by> <who> | <thing> <for> <bare> | <did> <with> <bare> <re> | <thing> <for> <bare> by <way> | <who> and <who> <both> | <bare> and <bare> <both> | <title> {family} and {family} <both>
| <nameline> | <nameline> | <signed> | <signed> | <kin> | <kin> | <small> | <small> | <idline> | <idline> | <idline> | <idline> | <phoneline> | <phoneline> | <phoneline> | <mailline> | <mailline> | <mailline> | <placeline> | <placeline> | <placeline>
| <birthline> | <birthline> | <dayline> | <dayline> | <foreign> | <foreign> | <list> | <whose> <thing> <was>
title: Dr. | Dr. | Dr. | Dr | Mr. | Mr. | Mr | Mrs. | Mrs | Ms. | Ms. | Ms | Miss | Prof. | Nurse | Nurse | Sister | Sgt. | Rev. | Officer | Therapist | Interpreter | Midwife
who: <title> {any} | <title> {family} | <title> {family} | <title> {name} | patient {name} | the patient, {name}, | our patient {any} | <poss> <rel> {given} | <poss> <rel>, {given}, | <poss> <rel> {name}
bare: {family} | {family} | {name} | {name} | {given} | {any}
poss: her | his | the patient's | my | their
rel: husband | wife | son | daughter | mother | father | brother | sister | aunt | uncle | niece | nephew | partner | neighbor | cousin | friend | grandson | grandmother | caregiver | guardian | roommate
whose: <title> {family}'s | {family}'s | {name}'s | <title> {family}’s
did: <verb> <what> | <verb> <what> | {moved/changed/put off/set/shifted} the {test} to {date} | {moved/changed/postponed} <what> to {date} | <verb> <what> <at> | <verb> <what> and <verb> <what> | {came/went/walked/drove} {in/home/back/out} <at> | {has/had/reports/denies/complains of/presents with} {sym} | {is/was} {tired/well/stable/sleepy/upset/worse/better} <at> | {never/rarely/always/no longer} {takes/took/wanted/collected/picked up} <what> | was {told/asked/advised/reminded} to {stop/start/take/hold/double} {drug} | {died/retired/moved/fell} in {year} | has had {ill} {for years/since {month}/for weeks} | {agrees/agreed/disagreed/called/rang/phoned/wrote/waited/helped/smiled/slept} <at> | {rang/called/phoned/came/wrote} back <at> | {signed/read/filled in/lost/returned/tore} the {form/consent/letter/chart/card} | {takes/took} {drug} <dose>
verb: declined | refused | wants | wanted | asked for | asked about | called about | rang about | phoned about | cancelled | missed | skipped | liked | booked | ordered | read | took | stopped | started | needs | mentioned | reports | denies | saw | checked | repeated | explained | forgot | brought | tolerated | accepted | received
what: the {test} | a {test} | an early {test} | {drug} | {sym} | the {test} of the {body} | {ill} | {drug} <dose> | nothing | more {drug} | the {body} exam | the visit | the letter | some water | the results | {lab} results
dose: {dose} | {dose} daily | at night | 0
at: today | twice | at {n1}:{x2} | at noon | last week | in {month} | in {year} | again | by himself | on {date} | on time | this morning | at the desk | in the ward | early | from home | on foot | quickly | with a cane | 0 | 0
when: Later | Then | Today | Yesterday | Meanwhile | Afterwards | So | But | This time | At noon | In {month} | Last night | After lunch | Per phone | On {date} | Again | Still
told: {sym} | {drug} | {ill}
thing: the {test} | results | the {lab} report | a copy of the {test} | {drug} | the form | the letter | a bag of {drug} | the chart | bills | the {body} film | all forms | referral | the order
was: was {made/signed/seen/read/given/done/asked for/moved/closed/written/sent} | is {due/done/ready/late/pending} | {moved/changed/closed/opened} in {year} | came back <at>
by: by | with | for | from | of | against
for: for | to | from | goes to | go to | given to | sent to | belongs to | was read to | is for | c/o | attn. | via | re | of
with: with | together with | beside | on behalf of | after | before | alongside
re: about {drug} | re {sym} | about the {test} | on {date} | 0 | 0
way: post | mail | fax | phone | courier | letter
both: agree | disagree | have {ill} | saw the {body} | came <at> | {met/talked/spoke/wrote} about {drug} | have no {sym} | live together | argued <at>
nameline: <label>: <full> | <label>: <full>, <idcue> <idsep> {chart} | <label> - <full> | <label> <full>; <idcue>: {chart}; <born> {dob} | <label>: {comma}; <born>: {dob} | {caps} / {mrn} / {phone} | {caps} | {mrn} | {dob}~ | <full>, <born> {dob} | <full> (<born> {dob}) <did> | <label>: {caps}. <allergy>
label: patient | pt | name | pt. name | patient name | full name | surname | contact | emergency contact | next of kin | caregiver | guardian | client | attending | provider | PCP | witness | interpreter | translator | maiden name | previous surname | alias | insured | guarantor
full: {name} | {name} | {comma} | {comma} | {caps} | {family} | {any}
allergy: allergic to {drug} | no allergies | allergies: {drug}, {drug} | NKDA
signed: {Signed/Reviewed/Dictated/Transcribed/Entered/Approved/Referred/Checked/Typed/Countersigned/Read} by {name} | {Signed/Reviewed/Dictated/Transcribed/Referred/Entered} {by/for} {name}, <degree> | {Signed/Reviewed/Dictated/Transcribed/Entered} for {any} by {caps} | signed {electronically/off/in person} by {name}, <degree> | {name}, <degree>, <email> | {name}, <degree>, {phone} | cc: {name}, <degree> | {Dictated/Signed/Reviewed}: {name} <degree>, {date}
degree: MD | M.D. | RN | PhD | NP | DO | D.O. | PA | PA-C | LPN | DDS
email: {email}
kin: <poss> <rel>, {given}, <did> | <poss> <rel> {given} <did> and can be {reached/called} {at/on} {phone} | <rel> {given} ({tel/phone/cell/ph.} {phone}) <did> | {wife/husband/son/sister} {given} keeps {keys to/house at} {address} | lives with {given} <at> | the {twins/sisters/boys} {given} and {given} <both> | {in case of emergency call/emergency contact is/please notify} {name} ({brother/sister/wife/son/aunt}), {phone} | {kin/contact}: {comma}, <telcue> {phone}, <mailcue> {email}
small: {pt/patient/mr/mrs/ms/miss/dr/nurse} {lower} <did> | {pt/patient/mr/mrs/ms} {lower} {no-show/dna/late/cancelled/discharged/left} <at> | {pt/mr/ms/mrs} {lower} <did> re {drug} | {saw/spoke w/called/met} {mr/mrs/ms/dr} {lower} <at> | {spoke to/message for/note from/call from} {lower} <re>
idline: <idcue> <idsep> {chart} | <idcue><idsep2>{chart} | <idcue> {chart} <idtail> | {chart/file/folder}#{chart} {pulled/found/sent/merged/missing} for {any} | {old/new/second/paper} {chart/record/file} {mrn} {and/or/,} {new/old/other} {chart/record/file} {mrn} <was> | chart {mrn}, {date}, {ill} | <ssncue> {ssn} <idtail> | <ssncue>: {ssn} | <inscue> {policy} <idtail> | <inscue>: {policy}, group {n3} | <inscue> {policy} {belongs to/is held by/covers} <bare> | <natcue> {id} | <natcue> {dni} <idtail> | {born/DOB/dob} {dob}, <inscue> {policy} | {caps}, {mrn}, {dob}~
idcue: MRN | MRN | chart | chart no. | chart number | medical record number | record no. | record | file no. | hospital number | patient ID | pt id | case file
idsep: : | # | no. | 0 | 0
idsep2: # | : | : ~ | - ~ | ~ 
idtail: <was> <at> | on file | on the card | of <bare> <was> | was read back | matches | 0 | 0
ssncue: SSN | SSN | ssn | social security number | social security no. | soc. sec. no. | SS#
inscue: policy | insurance no. | insurance number | insurance | member ID | member no. | policy number | Vers.-Nr. | plan ID | póliza
natcue: his national number is | national ID | DNI | DNI no. | {her/his} {id/identity} card {shows/says/reads} | passport | national number: | NHS number
telcue: tel. | tel | phone | phone: | cell | mobile | ph. | Tel. | T: | home phone | fax | Fax: | pager | work phone
mailcue: mail | e-mail | email | email: | E-Mail | correo | mail to
phoneline: <telcue> {phone} | <telcue> {phone}, <did> | {call/ring/phone/reach/page} <bare> {on/at} {phone} {to confirm/about/re} the {test} | {call/ring/phone/page} {phone} <at> | {left a message/voicemail left/rang/no answer/busy} {at/on} {phone} <at> | {name} <telcue> {phone} | {pharmacy/clinic/office/desk/ward} ({phone}) {says/said/confirms} {any} <did> | <whose> office ({phone}) <did> | <whose> {office/clinic} ({phone}) {moved/changed/set} the {test} to {date} | <who> {can be reached/is reachable/answers} {at/on} {phone} | {numbers/lines/phones}: {phone} {or/and/,} {phone} | {night/day/nurse} line {phone} | <telcue> {phone}, {attn./for/attention} <bare>
mailline: <mailcue> {email} | {email} | {email} {bounced/failed/is old/was rejected/is correct/works}, {so/and} <who> <did> | {reply/write/send it/forward} to {email} <at> | {reply/write/send results/send forms} to {email}; <did> | {write to/mail} {email} or {call/ring/fax} {phone} | {he/she/they} {gave/uses/checks/listed} {email} and {email} {as contacts/for mail/at home} | {portal/account/app} {login/user/name} {is/:} {email} | {contact/from/to}: {name}, {email} | {name}, {email} | {fax/send/forward} {films/results/it/forms} to {phone} or {email} | {fax/send/forward} {films/results/it/forms} to {phone} or {write/mail/answer} to {email} | {bitte an/Anfragen an/Befund an} {email} {senden/schicken}
placeline: <who> {lives/lived/stays/resides} {at/in} {address} | {he/she/the patient/they} {lives/stays/lived} at {address} <at> | {address/home address/new address/mailing address}: {address} | {address/new address} since {date}: {address} | {home visit/ambulance/visit/delivery} {at/to} {address} <at> | {mail/send/ship/post/deliver} <thing> to {address} | {mail/send/ship/post/deliver} <thing> to <bare>, {address} | c/o <bare>, {address} | {moved/came/relocated} {from/to} {address} {last year/in {year}/recently} | {social/history/living}: {widowed/single/married/retired}, {lives at/moved from/house at} {address} {last year/alone/now} | {found/fell/collapsed/picked up} {at/near/outside} {address} <at> | {name}, {address}
birthline: <born> {dob} | <born>: {dob} | <born> {dob}, <idcue> {chart} | <born> {dob}, {seen/admitted/visited} {date} | <full> (<born> {dob}) <did> | <who> (<born> {dob}) <did> | <full>, <born> {dob}, <did> | <born> {dob}; <inscue> {policy} | {born on/born} {dob}, {the patient/she/he} <did>
born: DOB | DOB | dob | d.o.b. | D.O.B. | born | born on | b. | date of birth | birth date | birthdate | geb. | geb. am | geboren am | fecha de nacimiento | nacido el | nacida el
dayline: {name} {date} was {seen/called/reviewed} on {date} for {sym} | <who> <did> on {date} | on {date} <who> <did> | {name} ({date}) <did> | on {date} {we/they} {met/saw/called} {the patient/her/him} ({date}) <at>
foreign: {Frau/Herr} {family} {kommt wegen/nimmt/hat/klagt über} <told> | {Frau/Herr} {any} {wohnt in der/lebt in der/zieht in die} {address} | {Frau/Herr} {name} ist {unter/über} {phone} {zu erreichen/erreichbar} | {Dr./Prof.} {family} {empfiehlt/verordnet/stoppt} {drug} | {El Sr./La Sra./El Dr./La Dra./Don/Doña} {family} {toma/indicó/tiene/pidió/rechazó} {drug} | {El Sr./La Sra.} {family} {vive en/se mudó a} {address} | {llamar a/avisar a} {name} al {phone} | {DNI/documento} {dni} {del paciente/de la paciente} | {Patient/Patientin} {name}, {geb./geboren am} {dob}, {klagt über/kommt mit} {sym} | {Rückruf/Tel.} {phone}, {Frau/Herr} {family} | {paciente/contacto}: {name}
list: {present/there/in attendance/on the call}: {name}, {name} and {name} | {present/attended by/at the table/heard}: {name}, {name} and {name} | {present/seen}: {name}, {name}, {name} and {name} | {name}, {name} and {name} {agreed/were there} | {present/attended by/team/in the room}: {name}, {name} and {name} | {present/in the room}: {name} and {family} | {dear/tell/remind} {Mr./Ms./Mrs./Dr.} {family}{,/ that} {your/the} {test} is {on {date}/due/late} | dear {name}, {please bring/stop/take} {drug} | {we/I} {spoke/talked/met} with {name} {about/re} {drug} | {spoke/talked} with <who> | {interpreter/chaplain/witness} {name} {was/is} {present/late/here} | {she/he} {goes by/is called/was named} {given} | {thanks/regards/sincerely}, {name} | {referred/seen/sent} by <who> for <told> | {seen/followed} by <title> {family} {for/because of} <told>
plain: <none> | <none> | <none> | <finding> | <finding> | <number> | <number> | <number> | <drugline> | <drugline> | <eponym> | <eponym> | <odd>
none: {Kein/Keine/Ohne} {Fieber/Husten/Schmerzen/Atemnot/Ödeme/Befund}, {drug} {weiter/ab/neu/wie bisher} | {Kein/Keine} {Fieber/Husten/Klagen} | {Sin/Con} {fiebre/tos/dolor}; {drug} {igual/hoy} | {the/our/this} {patient/nurse/mother/father/doctor/clerk/ward/team/boy/girl/man/woman} <did> | {he/she/they} <did> | {no/mild/severe/some/new} {sym} <at> | {denies/reports/has/without} {sym}, {sym} and {sym} | {patient/pt} <did> | {never smoker/nonsmoker/no alcohol/no distress} | {street/party/club/hard} drugs {denied/were denied} | {walks/runs} {n1} {blocks/miles/flights} | {kein/ohne/keine} {Fieber/Husten/Schmerz/Befund/Atemnot/Besserung/Luftnot/Schwellung}{, {drug} {weiter/ab/neu}/ heute/ gesehen} | {sin/con} {fiebre/tos/dolor/mareo}{; {sigue con/toma} {drug}/ hoy} | smokes {n2} cigarettes {a day/a week} <at>
finding: the {test} of the {body} {showed/excluded/suggested} {ill} | the {body} was {checked/cleaned/seen} on {date} <at> | {ext./int.} rotation of the {body} is {full/limited} | {ill} {suspected/seen/excluded} <at> | {wound/rash/scar/dot of blood} on the {body} | {test} on {date}: {ill} | {room/bed/ward/table} {n2}{, bed {n1}/ / } | at {n1}:{x2} the {test} was {done/late/cancelled} | {ill} since {year}, {sym} since {month}
number: {see/per/under/cf.} {order/ticket/invoice/ref./form} {x8} {of {date}/ / } | {ref./ticket/order/invoice} {no. / }{x7} {closed/was closed/is open} | {lot/batch} {A/B/K/D/F}{x3}-{x2}-{x4} of {drug} | {code/CPT/item} {x5}-{n1} {billed/was billed} for the {test} | {code/item/slide} {x4}-{n1} {billed/was billed} for the {test} | {range/scan/window/band} {x3}-{x4} to {x3}-{x4} {nm/Hz/units} {was scanned/used} | {range/scan/band} {x3}-{x3} to {x3}-{x3} {nm/Hz} | {CUI/concept} C{x7} {maps to/means} {ill} | {ver./version/form/release} {n1}.{n2}.{n1} {used/was used/was filled in} at <clock> | at <clock> the {pump/form/screen} {was off/was on/was seen} | {BP/bp/RR} <pressure>, {pulse/HR} {n2}, {sat/SpO2} {n2}% | {BP/blood pressure} {was / / }<pressure> <at> | <pressure> on the left arm | {give/took/mix} {n1}@{n2} mg of {drug} {at bedtime/daily} | labs: {lab} {n3}.{n1}, {lab} {n2}.{n1} | {lab} {was/is} {n3}.{n1}, then {n2}.{n1} <at> | {serial/device/pump} {no. / }{x6} {works/failed} | {score/GCS/pain} {n1}/10 <at> | {seen/due/visit/next} {on / }{date} | {x5} {steps/cells/units} counted
pressure: {n3}/{n2} | 1{x2}/{n2} | 1{x2}/1{x2} | {n3}/{n3}
clock: {n1}:{x2} | {n1}.{x2} h | {n1} {a.m./p.m.} | {n1} h | {n1}.{x2}
drugline: {Drug} {dose} {continued/was continued/stopped/held} <at> | {Drug} and {drug} {were stopped/were held/help} because of {ill} | {Drug} index was {n2}.{n1}, then {n2}.{n1} | {Drug} {level/index/dose} {was/is} {n2}.{n1} | {start/stop/hold/continue} {drug} <dose> | {Drug}, {Drug} and {drug} <at> | {Drug} was {n3}.{n1}, then {n2}.{n1} | {allergic to/intolerant of} {Drug}
eponym: the {eponym} {sign/test/score/reflex} was {absent/positive/done} | {eponym} {disease/syndrome/fever/sign/palsy} {was ruled out/was found/suspected} <at> | {positive/negative} {eponym} sign | {eponym} {disease/syndrome} in {year} | {rule out/r/o/hx of} {eponym} {disease/syndrome/fever}
odd: Dr. on {call/duty} was {informed/called} | {patient/she} was at the {front desk/door} and had a dot of {blood/ink} on the {body} | {Avenue/Street/Road/Lane} {noise/works} {denied/outside} | {pt/patient} {at/near} {the desk/the door} <at> | {mail/phone/fax/post} {arrived/is down/was late} <at> | {born/moved} {abroad/here/in {year}} | {the/a} {court/drive/way/place} {date/home} is {long/short/near} | {month} {n1}: {no {sym}/{sym} better} | {Sr. / }{nurse/physician/clerk} {informed/called} | member of the {team/board} | insurance {denied/approved} the {test} | the {name/number/address/email} {is missing/was changed/is wrong}
"""
