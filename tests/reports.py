"""An invented report of words: contents page, two balance sheet pages and a note page."""

WORDS = "doc string, page int, dpi int, pos int, text string, conf double, x0 double, y0 double, x1 double, y1 double"


class Report:
    def __init__(self, doc="acme"):
        self.doc, self.rows, self.count = doc, [], {}

    def line(self, page, y, *words, conf=0.9):
        for x0, x1, text in words:
            pos = self.count.get(page, 0)
            self.count[page] = pos + 1
            self.rows.append((self.doc, page, 300, pos, text, conf, float(x0), float(y), float(x1), float(y + 30)))

    def frame(self, spark):
        return spark.createDataFrame(self.rows, WORDS)


def label(x, text):
    out = []
    for w in text.split(" "):
        out.append((x, x + 12 * len(w), w))
        x += 12 * len(w) + 8
    return out


def amount(right, text):
    return (right - 14 * len(text), right, text)


def statement(r, page, title, rows):
    r.line(page, 100, *label(100, "ACME A.Ş."))
    r.line(page, 150, *label(100, title))
    r.line(page, 200, *label(100, "Tutarlar TL olarak gösterilmiştir"))
    r.line(page, 250, (880, 980, "Dipnot"), (1230, 1260, "31"), (1270, 1340, "Aralık"), (1345, 1400, "2012"), (1630, 1660, "31"), (1670, 1740, "Aralık"), (1745, 1800, "2011"))
    for i, (x, text, note, *values) in enumerate(rows):
        words = label(x, text) + ([(920, 945, note)] if note else [])
        words += [amount(right, v) for right, v in zip((1400, 1800), values, strict=False) if v]
        r.line(page, 300 + 50 * i, *words)
    r.line(page, 300 + 50 * len(rows), *label(100, "Ekteki dipnotlar bu tabloların parçasıdır"))


def report(doc="acme"):
    r = Report(doc)
    r.line(1, 100, *label(100, "İÇİNDEKİLER"))
    r.line(1, 200, *label(100, "NOT 3 NAKİT ....... 4"))
    r.line(1, 250, *label(100, "NOT 11 DEPO VE AMBAR"))
    r.line(1, 300, *label(100, "BİNALARI ....... 6-6"))
    statement(r, 2, "BİLANÇO", [
        (100, "DÖNEN VARLIKLAR", "", "60.000", "30.000"), (130, "Nakit", "3", "20.000", "10.000"), (130, "Alacak", "4", "40.000", "20.000"),
        (100, "DURAN VARLIKLAR", "", "500.000", "400.000"), (130, "Depo binaları", "1l", "500.000", "400.000"), (100, "TOPLAM", "", "560.000", "430.000"),
    ])
    statement(r, 3, "BİLANÇO", [
        (100, "KISA VADELİ", "", "160.000", "130.000"), (130, "Uzun adı olan borçlar ve", "", "", ""), (160, "diğerleri", "5", "100.000", "80.000"), (130, "Diğer", "6", "60.000", "50.000"),
        (100, "ÖZKAYNAK", "", "400.000", "300.000"), (130, "Sermaye", "7", "400.000", "300.000"), (100, "TOPLAM KAYNAK", "", "560.000", "430.000"),
    ])
    for page in (4, 5):
        r.line(page, 100, *label(100, "Metin sayfası"))
        r.line(page, 900, (500, 520, str(page - 1)))
    r.line(7, 100, *label(100, "11. DEPO VE AMBAR BİNALARI"))
    r.line(7, 150, *label(100, "Hareketler aşağıdadır"))
    r.line(7, 200, (1150, 1200, "Arsa"), (1350, 1400, "Bina"), (1520, 1600, "Toplam"))
    for i, (text, *values) in enumerate([("1 Ocak 2012 açılış", "300.000", "100.000", "400.000"), ("Alımlar", "50.000", "50.000", "100.000"), ("31 Aralık 2012 kapanış", "350.000", "150.000", "500.000")]):
        r.line(7, 250 + 50 * i, *label(100, text), *(amount(right, v) for right, v in zip((1200, 1400, 1600), values, strict=True)))
    r.line(7, 900, (500, 520, "6"))
    return r
