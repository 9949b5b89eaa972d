"""Dimension rows for the oracle, stated apart from the package so that an error in either shows."""

from __future__ import annotations

# --- fixed values (the public zone table's yellow zones, and the operators) -----
# id|zone|borough|service zone
_ZONES = """
4|Alphabet City|Manhattan|Yellow Zone
12|Battery Park|Manhattan|Yellow Zone
13|Battery Park City|Manhattan|Yellow Zone
24|Bloomingdale|Manhattan|Yellow Zone
43|Central Park|Manhattan|Yellow Zone
45|Chinatown|Manhattan|Yellow Zone
48|Clinton East|Manhattan|Yellow Zone
50|Clinton West|Manhattan|Yellow Zone
68|East Chelsea|Manhattan|Yellow Zone
79|East Village|Manhattan|Yellow Zone
87|Financial District North|Manhattan|Yellow Zone
88|Financial District South|Manhattan|Yellow Zone
90|Flatiron|Manhattan|Yellow Zone
100|Garment District|Manhattan|Yellow Zone
103|Governor's Island/Ellis Island/Liberty Island|Manhattan|Yellow Zone
104|Governor's Island/Ellis Island/Liberty Island|Manhattan|Yellow Zone
105|Governor's Island/Ellis Island/Liberty Island|Manhattan|Yellow Zone
107|Gramercy|Manhattan|Yellow Zone
113|Greenwich Village North|Manhattan|Yellow Zone
114|Greenwich Village South|Manhattan|Yellow Zone
125|Hudson Sq|Manhattan|Yellow Zone
137|Kips Bay|Manhattan|Yellow Zone
140|Lenox Hill East|Manhattan|Yellow Zone
141|Lenox Hill West|Manhattan|Yellow Zone
142|Lincoln Square East|Manhattan|Yellow Zone
143|Lincoln Square West|Manhattan|Yellow Zone
144|Little Italy/NoLiTa|Manhattan|Yellow Zone
148|Lower East Side|Manhattan|Yellow Zone
151|Manhattan Valley|Manhattan|Yellow Zone
158|Meatpacking/West Village West|Manhattan|Yellow Zone
161|Midtown Center|Manhattan|Yellow Zone
162|Midtown East|Manhattan|Yellow Zone
163|Midtown North|Manhattan|Yellow Zone
164|Midtown South|Manhattan|Yellow Zone
170|Murray Hill|Manhattan|Yellow Zone
186|Penn Station/Madison Sq West|Manhattan|Yellow Zone
194|Randalls Island|Manhattan|Yellow Zone
209|Seaport|Manhattan|Yellow Zone
211|SoHo|Manhattan|Yellow Zone
224|Stuy Town/Peter Cooper Village|Manhattan|Yellow Zone
229|Sutton Place/Turtle Bay North|Manhattan|Yellow Zone
230|Times Sq/Theatre District|Manhattan|Yellow Zone
231|TriBeCa/Civic Center|Manhattan|Yellow Zone
232|Two Bridges/Seward Park|Manhattan|Yellow Zone
233|UN/Turtle Bay South|Manhattan|Yellow Zone
234|Union Sq|Manhattan|Yellow Zone
236|Upper East Side North|Manhattan|Yellow Zone
237|Upper East Side South|Manhattan|Yellow Zone
238|Upper West Side North|Manhattan|Yellow Zone
239|Upper West Side South|Manhattan|Yellow Zone
246|West Chelsea/Hudson Yards|Manhattan|Yellow Zone
249|West Village|Manhattan|Yellow Zone
261|World Trade Center|Manhattan|Yellow Zone
262|Yorkville East|Manhattan|Yellow Zone
263|Yorkville West|Manhattan|Yellow Zone
"""
# id|code|name|taxi type|category
_OPERATORS = """
1|1|Creative Mobile Tech|yellow|Konvensional
2|2|VeriFone|yellow|Konvensional
3|HV0003|Uber|fhvhv|Modern
4|HV0005|Lyft|fhvhv|Modern
"""
# ------------------------------------------------------------------------------

ZONES = [(int(i), *rest) for i, *rest in (line.split("|") for line in _ZONES.split("\n") if line)]
OPERATORS = [(int(i), *rest) for i, *rest in (line.split("|") for line in _OPERATORS.split("\n") if line)]
