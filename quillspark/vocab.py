"""The domain vocabularies, and the vocabulary that the test tables' invented prose is scored with.

Each entry is rank:weight:term (rank:term where weights play no part); rank gives the order in which
matches are listed, entries are kept in alphabetical order.
"""

from __future__ import annotations

from quillspark.functions.terms import TermSet


def _parse(table: str, whole_words: bool = True) -> TermSet:
    rows = [line.strip().split(":", 2) for line in table.replace("|", "\n").splitlines() if line.strip()]
    ordered = sorted((int(r[0]), r[-1].strip(), int(r[1]) if len(r) == 3 else 1) for r in rows)
    return TermSet(tuple((t, w) for _, t, w in ordered), whole_words)


EN_DISEASE = _parse("""
20:3:breast abscess | 22:4:breast fistula | 10:6:breast tuberculosis | 15:3:corynebacterium | 14:5:corynebacterium kroppenstedtii
1:6:granulomatous lobular mastitis | 2:5:granulomatous mastitis | 0:6:idiopathic granulomatous mastitis | 9:5:mammary duct ectasia
23:4:mammary fistula | 11:6:mammary tuberculosis | 5:6:non-lactational mastitis | 3:6:non-puerperal mastitis
6:6:nonlactational mastitis | 4:6:nonpuerperal mastitis | 7:5:periductal mastitis | 8:5:plasma cell mastitis
17:6:recurrent granulomatous mastitis | 16:4:recurrent mastitis | 18:6:refractory granulomatous mastitis
19:6:relapsed granulomatous mastitis | 21:4:subareolar abscess | 13:6:tubercular mastitis | 12:6:tuberculous mastitis | 24:4:zuska
""")
EN_TREATMENT = _parse("""
18:2:antibiotic | 17:3:antibiotic therapy | 19:2:antibiotics | 4:3:combination therapy | 5:3:combined drug therapy | 14:3:corticosteroid
2:3:drug therapy | 12:3:ethambutol | 24:1:follow-up | 20:2:immunosuppressive | 11:3:isoniazid | 3:3:medical treatment | 13:3:methotrexate
6:3:multidrug therapy | 25:1:outcome | 16:3:prednisolone | 15:3:prednisone | 21:2:recurrence | 8:2:regimen | 22:2:relapse | 23:2:remission
9:3:rifampicin | 10:3:rifampin | 1:2:therapy | 0:2:treatment | 7:3:triple therapy
""")
EN_HUMAN = _parse("7:2:breast | 6:1:case report | 5:1:clinical | 4:1:female | 8:2:human | 0:2:patient | 1:2:patients | 2:2:woman | 3:2:women")
EN_EXCLUDE = _parse("""
0:8:bovine | 28:4:breast cancer | 25:6:breastfeeding | 18:7:buffalo | 19:7:buffaloes | 16:7:camel | 17:7:camels | 30:4:carcinoma
5:7:cattle | 33:5:cell line | 3:7:cow | 4:7:cows | 1:8:dairy cow | 2:8:dairy cows | 13:7:goat | 14:7:goats | 6:6:herd
29:5:inflammatory breast cancer | 9:8:intramammary | 24:6:lactational mastitis | 10:7:milk yield | 22:7:mouse mastitis
23:7:murine mastitis | 34:4:nanoparticle | 35:4:plant extract | 21:7:porcine | 26:5:postpartum | 27:5:puerperal mastitis | 15:7:sheep
11:7:somatic cell count | 20:7:sow | 8:7:teat | 31:3:tumor | 32:3:tumour | 7:8:udder | 12:8:veterinary
""")
EN_STRONG = frozenset(EN_DISEASE.names[:14])
#: Animal terms that outweigh weak target evidence in an article, and those that send a chunk of a kept article to review.
EN_ANIMAL_HEAVY = frozenset(EN_EXCLUDE.names[:22]) - {"milk yield", "somatic cell count"}
EN_CHUNK_NOISE = frozenset(EN_EXCLUDE.names[:22]) - {"intramammary"}

ANIMAL = _parse("""
0:bovine | 24:buffalo | 25:buffaloes | 9:bulk tank milk | 22:camel | 23:camels | 5:cattle | 3:cow | 4:cows | 6:dairy cattle | 1:dairy cow
2:dairy cows | 7:dairy farm | 8:dairy farms | 20:ewe | 21:ewes | 17:goat | 18:goats | 10:herd | 13:intramammary | 31:mice | 15:milk yield
30:mouse model | 29:murine mastitis | 26:porcine | 32:rat model | 33:rats | 19:sheep | 14:somatic cell count | 27:sow | 28:sows | 12:teat
11:udder | 16:veterinary
""")
HUMAN_TARGET = TermSet.of(EN_DISEASE.names[:10] + EN_DISEASE.names[10:14])
HUMAN_CONTEXT = _parse("7:clinical presentation | 8:clinical treatment | 4:female patient | 5:female patients | 6:human breast | 0:patient | 1:patients | 2:woman | 3:women")
HUMAN_TITLE = _parse("9:breastfeeding | 0:human | 7:infant | 8:infants | 5:mother | 6:mothers | 1:patient | 2:patients | 3:woman | 4:women")
ANCHOR_CONDITION = TermSet.of(["mastitis"])
ANCHOR_CONTEXT = TermSet.of(["diagnosis", "patients", "recurrence", "therapy", "treatment"])

ZH_DISEASE = _parse("""
8:8:乳腺导管扩张症 | 12:7:乳腺导管炎 | 13:9:乳房结核 | 11:8:乳管周围炎 | 9:8:乳管扩张症 | 15:7:克氏棒状杆菌 | 16:6:复发性乳腺炎 | 10:9:导管周围乳腺炎
7:9:浆细胞乳腺炎 | 6:9:浆细胞性乳腺炎 | 4:10:特发性肉芽肿性乳腺炎 | 14:9:结核性乳腺炎 | 5:9:肉芽肿性乳腺炎 | 3:10:肉芽肿性小叶性乳腺炎
2:10:非产褥期乳腺炎 | 0:10:非哺乳期乳腺炎 | 1:10:非哺乳期乳腺炎症
""", whole_words=False)
ZH_TREATMENT = _parse("""
3:5:三联疗法 | 4:5:三联治疗 | 8:5:乙胺丁醇 | 19:3:克拉霉素 | 6:5:利福平 | 9:4:吡嗪酰胺 | 14:4:地塞米松 | 28:2:复发 | 20:3:阿奇霉素 | 18:3:阿莫西林
22:3:庆大霉素 | 7:5:异烟肼 | 12:4:强的松 | 5:5:抗结核治疗 | 17:3:抗生素 | 21:3:左氧氟沙星 | 23:2:治疗 | 11:4:泼尼松 | 10:4:甲氨蝶呤 | 13:4:甲泼尼龙
25:2:疗效 | 24:2:疗法 | 27:3:疗程 | 16:3:类固醇激素 | 15:3:糖皮质激素 | 29:2:缓解 | 2:3:联合治疗 | 1:4:联合用药 | 0:4:药物治疗 | 26:2:诊治
30:1:随访 | 31:1:预后
""", whole_words=False)
ZH_HUMAN = _parse("3:2:临床 | 8:1:住院 | 5:2:乳腺 | 6:2:乳房 | 4:1:例 | 1:2:女性 | 0:3:患者 | 2:2:病例 | 7:2:病人", whole_words=False)
ZH_ANIMAL = _parse("""
12:8:产奶量 | 3:10:乳牛 | 14:8:乳头浸浴 | 15:5:乳区 | 13:8:体细胞数 | 8:10:兽医 | 2:10:奶牛 | 0:12:奶牛乳腺炎 | 11:9:奶牛场 | 4:10:奶山羊
5:12:山羊乳腺炎 | 16:9:泌乳牛 | 1:12:牛乳腺炎 | 10:7:牧场 | 9:8:畜牧 | 6:12:绵羊乳腺炎 | 7:11:羊乳腺炎
""", whole_words=False)
ZH_LACTATIONAL = _parse("3:7:产后乳腺炎 | 1:8:产褥期乳腺炎 | 0:8:哺乳期乳腺炎 | 2:6:母乳喂养 | 5:4:积乳 | 4:5:通乳", whole_words=False)
ZH_OTHER = _parse("2:5:乳腺肿瘤 | 0:5:乳腺癌 | 4:7:动物模型 | 1:7:炎性乳腺癌 | 3:5:细胞株", whole_words=False)
ZH_CONDITION = "乳腺炎"

RISK = _parse("3:100%有效 | 0:保证治愈 | 1:一定治愈 | 2:一定有效 | 4:完全有效 | 5:必然有效 | 6:无需医生 | 7:替代医生", whole_words=False)
ADVICE = _parse("3:应该换药 | 2:可以换药 | 4:应立即停药 | 0:建议患者使用 | 1:建议患者改用 | 5:不需要就医 | 6:无需就医", whole_words=False)

# Words that the invented prose of the test tables has, in the roles of the classes above.
FIX_DISEASE = _parse("0:6:attion to | 1:6:that the | 2:5:thtion | 3:4:eriner thanea | 4:4:elle la | 5:3:der der | 6:3:onbleing")
FIX_TREATMENT = _parse("0:3:eron | 1:2:thing | 2:2:erble | 3:2:from | 4:1:ment")
FIX_HUMAN = _parse("0:2:are | 1:2:les | 2:1:thst | 3:1:nicht")
FIX_EXCLUDE = _parse("0:8:thnt | 1:7:reen | 2:6:onre | 3:5:eau | 4:4:anha | 5:3:ble")
FIX_STRONG = frozenset({"attion to", "that the", "thtion", "elle la"})
FIX_HEAVY = frozenset({"thnt", "reen", "onre"})
FIX_NOISE = frozenset({"thnt", "onre", "eau"})
