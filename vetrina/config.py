"""Every threshold of the listings funnel, as one value."""

from __future__ import annotations

from dataclasses import dataclass, field

#: Stop-words in the order in which they are looked for.
STOPWORDS = (
    "копия", "копии", "копий", "копию", "копией", "реплика", "реплики", "реплику", "подделка", "подделки", "подделок", "подделку",
    "фейк", "fake", "replica", "copy", "имитация", "имитации", "имитацию", "аналог", "аналоги", "аналогов", "аналогу",
    "не оригинал", "неоригинал", "неоригинальный", "неоригинальная", "китай", "китайский", "китайская", "китайские", "china",
    "подобие", "как оригинал", "дубликат", "дубликаты", "дубль", "дубли",
    "б/у", "бу", "б у", "использованный", "использованная", "использованные", "ношенный", "ношеный", "поношенный",
    "second hand", "second-hand", "secondhand", "used", "worn", "pre-owned", "preowned", "pre owned", "после носки", "поноска",
    "с дефектами", "дефект", "дефекты", "дефектов", "потертости", "потёртости", "потертость", "потёртость",
    "царапины", "царапина", "царапин", "следы носки", "требует ремонта", "на запчасти", "не новый", "не новая",
    "advics", "afire", "alnsu", "ap racing", "aspaco", "borgwarner", "dagger", "depo", "febest", "fogel", "garrett", "gtr-t",
    "jorden", "jrone", "marshall", "miessler", "mibu", "nty", "oemparts", "patron", "power kit", "powerstop", "rumc", "sonne",
    "standart", "steering pro", "tebochi", "termal", "1aaaparts",
)


@dataclass(frozen=True)
class Config:
    min_price: float = 1000.0
    min_items: int = 5
    min_reviews: int = 0
    require_images: bool = True
    check_prices: bool = True
    stopwords: tuple[str, ...] = field(default=STOPWORDS)
    fence: float = 1.0
    extreme: float = 2.5
    cheap_share: float = 0.2
    small_bound: float = 3.0
    white_level: float = 250.0
    white_share: float = 0.30
    model_rows: int = 30


#: The funnel's settings on the test tables, so that every stage and gate bites.
FIXTURE = Config(min_price=8000.0, min_items=12, min_reviews=5, stopwords=("not specified", "urgent", "low"), white_level=0.0, white_share=0.56, model_rows=10)
