"""Codes of findings and the consolidation of all findings of an object."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Code and description of every kind of finding.
ERR_CODES = [
    ("1", "Дублирование геометрий объектов"),
    ("2", "Частичное наложение геометрий объектов"),
    ("3", "Возможно, ошибка в направлении течения"),
    ("4", "Проблема с рангом"),
    ("5", "Водоток не соединён с сетью"),
    ("6-1", "'tunnel' = 'culvert' длиной более 100 м. Для протяжённых подземных коллекторов правильнее использовать 'tunnel' = 'yes'"),
    ("6-2", "Если это акведук (мост по которому течёт вода), то не хватает тегов 'bridge' = 'aqueduct'"),
    ("6-3", "Вместо 'landuse' = 'reservoir' рекомендуется использовать 'natural' = 'water' + 'water' = 'reservoir'"),
    ("6-4", "Ключ 'water:type' не рекомендуется к использованию"),
    ("6-5-1", "Устаревшие теги. Вместо 'water' = 'tidal' используйте 'tidal' = 'yes'"),
    ("6-5-2", "Устаревшие теги. Вместо 'water' = 'tidal' используйте 'natural' = 'water' + 'tidal' = 'yes'"),
    ("6-6-1", "Устаревшие теги. Вместо 'water' = 'intermittent' используйте 'intermittent' = 'yes'"),
    ("6-6-2", "Устаревшие теги. Вместо 'water' = 'intermittent' используйте 'natural' = 'water' + 'intermittent' = 'yes'"),
    ("6-7-1", "Вместо 'water' = 'cove' используйте  'natural' = 'bay'"),
    ("6-7-2", "Вместо 'water' = 'bay' используйте  'natural' = 'bay'"),
    ("6-8", "Вместо 'water' = 'fishpond' рекомендуется использовать 'water' = 'pond' в сочетании с 'landuse' = 'aquaculture' или 'leisure' = 'fishing'"),
    ("6-9", "Вместо 'water' = 'riverbank' рекомендуется использовать 'natural' = 'water' + 'water' = 'river'"),
    ("6-10", "Вместо 'waterway' = 'riverbank' рекомендуется использовать 'natural' = 'water' + 'water' = 'river'"),
    ("6-11", "Теги 'water' = 'natural' устарели"),
    ("6-12", "'waterway' = 'rapids' -> 'water' = 'rapids'"),
    ("6-13", "'waterway' = 'intermittent' лучше убрать"),
    ("6-14", "'waterway' = 'intermittent' -> 'intermittent' = 'yes'"),
    ("6-15", "'waterway' = 'bog' -> 'wetland' = 'bog'"),
    ("6-16", "'waterway' = 'tidal' -> 'tidal' = 'yes'"),
    ("6-17", "'waterway' = 'wetland' -> 'natural' = 'wetland'"),
    ("6-18", "Вместо 'waterway' = 'riverbank' рекомендуется использовать 'natural' = 'water' + 'water' = 'river'"),
    ("6-19", "'waterway' = 'pond' -> 'water' = 'pond'"),
    ("6-20", "'waterway' = 'lake' -> 'water' = 'lake'"),
    ("6-21", "'waterway' = 'canal' -> 'water' = 'canal'"),
    ("6-22", "'waterway' = 'reservoir' -> 'water' = 'reservoir'"),
    ("6-23", "'waterway' = 'oxbow' -> 'water' = 'oxbow'"),
    ("6-24", "'waterway' = 'water_point' -> 'water' = 'water_point'"),
    ("6-25", "'waterway' = 'pressurised' -> 'water' = 'pressurised'"),
    ("6-26", "'waterway' = 'river' -> 'water' = 'river'"),
    ("6-27", "'waterway' = 'pumping_station' -> 'man_made' = 'pumping_station'"),
    ("6-28-1", "'waterway' = 'island' -> 'place' ='island'"),
    ("6-28-2", "'waterway' = 'island' -> 'place' ='islet'"),
    ("6-29-1", "'waterway' = 'ditch' замкнутый контур лучше разомкнуть и убрать теги 'area' = 'no'"),
    ("6-29-2", "'waterway' = 'ditch' замкнутый контур лучше разомкнуть"),
    ("6-30", "'waterway' = 'drain' не рекомендуется использовать на площадном объекте"),
    ("6-31", "'waterway' = 'weir' не рекомендуется использовать на площадном объекте"),
    ("6-32", "'waterway' = 'brook' не рекомендуется использовать на площадном объекте"),
    ("6-33", "'waterway' = 'waterfall' не рекомендуется использовать на площадном объекте"),
    ("6-34", "'waterway' = 'lock_gate' не рекомендуется использовать на площадном объекте"),
    ("6-35", "Площадной водный объект с тегом waterway"),
    ("6-40", "Возможно, сломанный площадной объект"),
    ("6-41", "Вероятно, ключ 'water' лишний"),
    ("6-42", "'water' = 'spring -> 'waterway' = 'stream'"),
    ("6-43", "'water' = 'rapids' -> 'waterway' = 'rapids'"),
    ("6-44", "Ключ 'water' не рекомендуется использовать на линейном объекте"),
    ("6-45", "Старица реки обозначается тегами 'waterway' = 'oxbow'. 'Старица' в названии не несёт смысла. Ключ 'name' лучше убрать."),
    ("6-46", "Старица реки обозначается тегами 'waterway' = 'oxbow'"),
    ("6-47", "Нужно убрать статусную часть из названия"),
    ("6-48", "В ключе name статусная часть вместо названия"),
    ("6-50", "Судя по названию, это может быть 'waterway' = 'river'"),
    ("6-51", "'waterway' = 'wadi' — устаревший тег (deprecated в OSM wiki). Замените на 'waterway' = 'river'/'stream' + 'intermittent' = 'yes', либо 'natural' = 'valley' — по месту"),
    ("6-52", "'waterway' = 'waterfall' на линии — по конвенции OSM это точка (node)"),
    ("6-53", "'waterway' = 'oxbow' на линии — рекомендуется 'natural' = 'water' + 'water' = 'oxbow' на полигоне (см. также 6-23)"),
    ("6-54", "'natural' = 'water' на линейном объекте — этот тег для площадных объектов, нужен контур"),
    ("6-55", "'natural' = 'wetland' на линейном объекте — этот тег для площадных объектов, нужен контур"),
]


def err_codes(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(ERR_CODES, "err_id string, description string")


def consolidate(findings: list[DataFrame]) -> DataFrame:
    """All findings of an object: ``osm_id, err_ids, err_list``.

    findings: ``osm_id, err_id``. Rows with a null code are dropped. Codes and
    descriptions are two independent sorted sets: equal descriptions of two codes are one,
    and a code without description adds a null at the end of ``err_list``.
    """
    all_ = findings[0]
    for f in findings[1:]:
        all_ = all_.unionByName(f)
    codes = err_codes(all_.sparkSession)  # a fixed table of 60 rows
    j = all_.where("err_id is not null").distinct().join(F.broadcast(codes), "err_id", "left")
    described = F.array_sort(F.collect_set(F.struct(F.col("description").isNull().alias("n"), "description")))
    return j.groupBy("osm_id").agg(F.array_sort(F.collect_set("err_id")).alias("err_ids"), F.transform(described, lambda s: s["description"]).alias("err_list"))
