"""Knowledge of the domain for mapping typed values: other names of list entries, and names that are no entry."""

from __future__ import annotations

# By vocabulary and code, further names, in English, German, French and Spanish, and usual short forms.
ALIASES = {
    "country": {
        "US": "us|u s a|america|estados unidos|etats unis|vereinigte staaten|eeuu|usa",
        "GB": "gbr|england|scotland|wales|northern ireland|britain|royaume uni|reino unido|vereinigtes konigreich|grossbritannien|great britain",
        "DE": "deu|ger|brd|allemagne|alemania|federal republic of germany",
        "FR": "fra|frankreich|francia",
        "ES": "esp|espagne|spanien",
        "SE": "swe|suede|schweden|suecia",
        "FI": "fin|finlande|finnland|finlandia",
        "IE": "irl|irland|irlande|irlanda|eire|republic of ireland",
        "NL": "nld|the netherlands|niederlande|pays bas|paises bajos|nederland|hollande",
        "AU": "aus|australien|australie",
        "JP": "jpn|japon|nihon",
        "CN": "chn|chine|p r china|people s republic of china|peoples republic of china|mainland china",
        "IN": "ind|indien|inde|republic of india",
        "BD": "bgd|bangla desh|bangladesch",
        "NG": "nga|nigerien|federal republic of nigeria",
        "KE": "ken|kenia|republic of kenya",
        "MW": "mwi|republic of malawi",
        "CO": "col|kolumbien|colombie|republic of colombia",
        "BR": "bra|brasilien|bresil",
        "SI": "svn|slowenien|slovenie|eslovenia|slovenija",
    },
    "delivery_mode": {
        "vaginal": "vag|svd|nvd|normal delivery|normal vaginal delivery|voie basse|parto normal|parto vaginal|vaginally|vaginalgeburt|spontangeburt|accouchement par voie basse|vaginal forceps|normal birth|spontaneous delivery|vbac",
        "csection": "cs|c s|c section|lscs|sectio|kaiserschnitt|cesarienne|cesarea|caesarian|cesarian|cesarean section|caesarean|caesarean delivery|cesarean delivery|sectio caesarea|operative abdominal delivery",
    },
    "feeding_mode": {
        "exclusive_breast": "breastfed|breast fed|breastfeeding|exclusive breastfeeding|exclusive breast feeding|exclusive breast|bf exclusive|bf|ausschliesslich gestillt|gestillt|allaitement exclusif|allaitement maternel|lactancia materna exclusiva|only mother s own milk|only mothers own milk|mother s milk|100 breast milk|breast milk|breast only|nursing only|human milk only",
        "formula": "ff|formulanahrung|lait artificiel|infant formula|infant formula exclusively|bottle fed formula|formula feeding|exclusive formula|leche de formula|lait infantile|flaschennahrung",
        "mixed": "combi fed|allaitement mixte|lactancia mixta|bf ff|partially breastfed formula too|breast milk w formula top ups|breast milk with formula top ups|mixed fed|combination feeding|partial breastfeeding|breast milk and formula|breastfed and formula|mischernahrung|zwiemilch",
        "donor_milk": "pasteurised donor milk|pasteurized donor milk|donor milk|spendermilch|milk bank|lait de don|leche donada|banked milk",
        "solids": "table food|family foods|family food|beikost|weaned|solids|solid food|weaning foods|complementary feeding|aliments solides|alimentos solidos",
    },
    "health_condition": {
        "healthy_control": "normal controls|normal control|hc|asymptomatic|gesund|sain|sano|no disease|disease free|healthy volunteer|healthy subject|controls|control group|temoin|kontrolle",
        "crohns_disease": "cd|crohn|crohns|morbus crohn|maladie de crohn|enfermedad de crohn|ileal crohns|regional enteritis",
        "ulcerative_colitis": "uc|colitis ulcerosa|rectocolite hemorragique|colite ulcereuse|ulcerative proctitis",
        "ibs": "reizdarm|reizdarmsyndrom|spastic colon|ibs d|ibs c|ibs m|syndrome de l intestin irritable|colon irritable|sindrome de intestino irritable",
        "colorectal_cancer": "colon carcinoma|colon cancer|bowel cancer|darmkrebs|rectal ca|rectal cancer|colorectal carcinoma|cancer colorectal|crc|colorectal adenocarcinoma",
        "type_2_diabetes": "t2dm|niddm|dm2|adult onset diabetes|diabetes mellitus type ii|diabetes mellitus type 2|type ii diabetes|diabetes type 2|diabete de type 2|diabetes tipo 2",
        "type_1_diabetes": "t1dm|iddm|dm1|juvenile diabetes|diabetes mellitus type i|diabetes mellitus type 1|type i diabetes|diabetes type 1|diabete de type 1|diabetes tipo 1",
        "obesity": "obese|adipositas|obesite|obesidad|bmi class iii|bmi class ii|bmi class i|class iii obesity|morbid obesity",
        "nec": "necrotizing enterocolitis|enterocolite necrosante|nekrotisierende enterokolitis|bell stage 1|bell stage 2|bell stage 3|enterocolitis necrotizante",
        "allergy_or_atopy": "allergic|allergy|atopy|atopic|atopic eczema|atopic dermatitis|eczema|asthma|asthma eczema|cow s milk allergy|cows milk allergy|food allergy|allergie|alergia|hay fever",
        "malnutrition": "sam|mam|stunted|stunting|wasted|wasting|undernourished|undernutrition|underweight|severe acute malnutrition|moderate acute malnutrition|kwashiorkor|marasmus|unterernahrung|desnutricion",
    },
    "body_site": {
        "gut_stool": "fecal|faecal|fecal sample|faecal sample|stuhl|stuhlprobe|selles|heces|meconium|diaper stool|gut|rectal swab|rectum|rectal|feaces|excrement|gut stool",
        "oral": "oral|mouth|speichel|salive|tongue dorsum|tongue|dental plaque|buccal swab|buccal|buccal mucosa|gingiva|mund|bouche|boca|throat",
        "skin": "haut|peau|piel|axilla|forearm|forearm skin swab|epidermis|armpit",
        "nasal_nasopharyngeal": "np swab|np|anterior nares|nares|nose|nasopharyngeal|nasopharyngeal swab|nostril|nase|nez|nariz",
        "vaginal_urogenital": "vaginal|vaginal swab|posterior fornix|urine|urogenital|introitus|cervix|vagin|scheide",
        "milk": "milk|colostrum|muttermilch|lait maternel|leche materna|expressed milk|mother s milk|human breast milk",
        "blood_tissue": "whole blood|cord blood|plasma|serum|blut|sang|sangre|tissue|biopsy|venous blood|buffy coat",
    },
    "sex": {
        "female": "f|w|girl|woman|women|fem|weiblich|femenino|femme|fille|feminin|mujer|nina|frau|madchen",
        "male": "m|boy|man|men|masc|mannlich|masculino|homme|garcon|masculin|hombre|nino|mann|junge",
    },
}
# Names of things that are no entry although they look like one, by vocabulary.
OTHERS = {
    "country": "afghanistan|albania|algeria|andorra|angola|argentina|armenia|austria|osterreich|autriche|azerbaijan|bahamas|bahrain|barbados|"
    "belarus|belgium|belgien|belize|benin|bhutan|bolivia|bosnia and herzegovina|botswana|brunei|bulgaria|burkina faso|burundi|cambodia|"
    "cameroon|canada|kanada|cape verde|chad|chile|comoros|congo|costa rica|croatia|cuba|cyprus|czechia|czech republic|denmark|danemark|djibouti|"
    "dominica|dominican republic|ecuador|egypt|el salvador|equatorial guinea|eritrea|estonia|eswatini|ethiopia|fiji|gabon|gambia|"
    "georgia|ghana|greece|grenada|guatemala|guinea|guinea bissau|guyana|haiti|honduras|hungary|iceland|indonesia|iran|iraq|israel|"
    "italy|italien|ivory coast|jamaica|jordan|kazakhstan|kiribati|kuwait|kyrgyzstan|laos|latvia|lebanon|lesotho|liberia|libya|liechtenstein|"
    "lithuania|luxembourg|madagascar|malaysia|maldives|mali|malta|mauritania|mauritius|mexico|micronesia|moldova|monaco|mongolia|"
    "montenegro|morocco|mozambique|myanmar|namibia|nauru|nepal|new zealand|nicaragua|niger|north korea|norway|norwegen|oman|pakistan|palau|"
    "panama|papua new guinea|paraguay|peru|philippines|poland|polen|portugal|qatar|romania|russia|rwanda|samoa|saudi arabia|senegal|"
    "serbia|seychelles|sierra leone|singapore|slovakia|slowakei|solomon islands|somalia|south africa|south korea|south sudan|sri lanka|sudan|"
    "suriname|swaziland|switzerland|schweiz|syria|taiwan|tajikistan|tanzania|thailand|togo|tonga|trinidad and tobago|tunisia|turkey|"
    "turkmenistan|tuvalu|uganda|ukraine|united arab emirates|uruguay|uzbekistan|vanuatu|vatican|venezuela|vietnam|yemen|zambia|zimbabwe",
    "health_condition": "microscopic colitis|celiac disease|coeliac disease|gestational diabetes|prediabetes|hypertension|hypothyroid|colitis|"
    "gastric cancer|breast cancer|lung cancer|psoriasis|migraine",
    "body_site": "mouse caecum|house dust|river water|soil|sediment|hospital floor|extraction blank|incubator handle|sink|shin|milk powder|cow milk|blank",
    "sex": "mixed|pooled|both|hermaphrodite|intersex|male and female|female and male",
    "feeding_mode": "parenteral nutrition|intravenous dextrose|ketogenic",
    "delivery_mode": "",
}
