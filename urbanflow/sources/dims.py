"""Small, fixed dimensions as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..schemas import STATION

# The station registry of the weather feed
# (name, latitude, longitude, department, zone, altitude in m).
STATIONS = [
    ("Paris-1er-Louvre", 48.8606, 2.3376, "75", "Paris", 35),
    ("Paris-2e-Bourse", 48.8698, 2.3412, "75", "Paris", 36),
    ("Paris-3e-Temple", 48.8630, 2.3626, "75", "Paris", 38),
    ("Paris-4e-Hotel-de-Ville", 48.8566, 2.3522, "75", "Paris", 34),
    ("Paris-5e-Pantheon", 48.8462, 2.3372, "75", "Paris", 61),
    ("Paris-6e-Luxembourg", 48.8462, 2.3372, "75", "Paris", 54),
    ("Paris-7e-Palais-Bourbon", 48.8566, 2.3065, "75", "Paris", 39),
    ("Paris-8e-Elysee", 48.8742, 2.3170, "75", "Paris", 43),
    ("Paris-9e-Opera", 48.8742, 2.3387, "75", "Paris", 67),
    ("Paris-10e-Enclos-St-Laurent", 48.8760, 2.3590, "75", "Paris", 40),
    ("Paris-11e-Popincourt", 48.8631, 2.3708, "75", "Paris", 50),
    ("Paris-12e-Reuilly", 48.8448, 2.3895, "75", "Paris", 45),
    ("Paris-13e-Gobelins", 48.8322, 2.3561, "75", "Paris", 42),
    ("Paris-14e-Observatoire", 48.8339, 2.3265, "75", "Paris", 59),
    ("Paris-15e-Vaugirard", 48.8422, 2.2966, "75", "Paris", 45),
    ("Paris-16e-Passy", 48.8590, 2.2742, "75", "Paris", 71),
    ("Paris-17e-Batignolles", 48.8839, 2.3154, "75", "Paris", 47),
    ("Paris-18e-Montmartre", 48.8922, 2.3444, "75", "Paris", 108),
    ("Paris-19e-Buttes-Chaumont", 48.8799, 2.3783, "75", "Paris", 63),
    ("Paris-20e-Menilmontant", 48.8649, 2.3969, "75", "Paris", 96),
    ("Boulogne-Billancourt", 48.8414, 2.2400, "92", "Hauts-de-Seine", 37),
    ("Nanterre", 48.8924, 2.2069, "92", "Hauts-de-Seine", 40),
    ("Levallois-Perret", 48.8979, 2.2877, "92", "Hauts-de-Seine", 30),
    ("Saint-Denis", 48.9362, 2.3574, "93", "Seine-Saint-Denis", 33),
    ("Montreuil", 48.8618, 2.4440, "93", "Seine-Saint-Denis", 82),
    ("Bobigny", 48.9077, 2.4174, "93", "Seine-Saint-Denis", 42),
    ("Créteil", 48.7906, 2.4550, "94", "Val-de-Marne", 48),
    ("Vincennes", 48.8483, 2.4388, "94", "Val-de-Marne", 51),
    ("Nogent-sur-Marne", 48.8370, 2.4823, "94", "Val-de-Marne", 39),
    ("Versailles", 48.8014, 2.1301, "78", "Yvelines", 132),
    ("Saint-Germain-en-Laye", 48.9014, 2.0936, "78", "Yvelines", 78),
    ("Cergy-Pontoise", 49.0205, 2.0781, "95", "Val-d'Oise", 30),
    ("Roissy-CDG", 49.0097, 2.5479, "95", "Val-d'Oise", 119),
    ("Meaux", 48.9559, 2.8781, "77", "Seine-et-Marne", 51),
    ("Fontainebleau", 48.4020, 2.7019, "77", "Seine-et-Marne", 115),
    ("Evry", 48.6247, 2.4437, "91", "Essonne", 78),
    ("Orly", 48.7436, 2.4090, "94", "Val-de-Marne", 89),
]


def stations(spark: SparkSession) -> DataFrame:
    """The 37-row station registry (bounded: safe to broadcast)."""
    return spark.createDataFrame(STATIONS, STATION)
