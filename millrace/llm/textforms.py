"""Text folding shared by the entity operators."""

from __future__ import annotations

import re
import unicodedata

# Traditional characters and their simplified forms, as far as place and firm names use them.
_TRADITIONAL = "谿硯闕灣蕩鷺塢營瀾嶼澤雲溝楓嵐軟業傳嶽車銳藥電東貿網絡機紡織環險詢醫療設農運儀樣蘇蘭漢寧廣鴻鵬鵠麥葦銘鈞鈺鉑鐸錦鐳綾繡綸箋箏簫滄淵啟堯榮豐鳳龍馬長開關陽陳凱華國臺遼橋鎮號園區縣鄉學總遠駐場責團實術數產務聯傑倫偉優億儲靈靜顧頂領駿騰鶴齊穀岡峽島嶺巖埡潤紅軍發達勝亞匯慶賢禮維遊蔣蓮葉櫻樺檸檢歷歐滬瀋灘燦爾獅瑋當礦種紀純紐約級細終結統綠維緯縱繼續買費賀賽贏輝輪遷"
_SIMPLIFIED = "溪砚阙湾荡鹭坞营澜屿泽云沟枫岚软业传岳车锐药电东贸网络机纺织环险询医疗设农运仪样苏兰汉宁广鸿鹏鹄麦苇铭钧钰铂铎锦镭绫绣纶笺筝箫沧渊启尧荣丰凤龙马长开关阳陈凯华国台辽桥镇号园区县乡学总远驻场责团实术数产务联杰伦伟优亿储灵静顾顶领骏腾鹤齐谷冈峡岛岭岩垭润红军发达胜亚汇庆贤礼维游蒋莲叶樱桦柠检历欧沪沈滩灿尔狮玮当矿种纪纯纽约级细终结统绿维纬纵继续买费贺赛赢辉轮迁"
SIMPLIFY = str.maketrans(_TRADITIONAL, _SIMPLIFIED)
_FOLDS = re.compile(f"[{_TRADITIONAL}]")


def simplify(text: str) -> str:
    """Compatibility forms folded, case folded, simplified characters."""
    if text.isascii():
        return text.lower()
    if not unicodedata.is_normalized("NFKC", text):
        text = unicodedata.normalize("NFKC", text)
    return (text.translate(SIMPLIFY) if _FOLDS.search(text) else text).casefold()


def osa_distance(a: str, b: str, most: int) -> int:
    """Edit distance with adjacent transpositions; ``most + 1`` if beyond ``most``."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    older: list[int] = []
    old = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            d = min(old[j] + 1, new[j - 1] + 1, old[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, older[j - 2] + 1)
            new.append(d)
        if min(new) > most:
            return most + 1
        older, old = old, new
    return min(old[-1], most + 1)
