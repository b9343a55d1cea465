"""Small inputs: invented rows, and below them records the results of which are known."""

BANDS = """\
{"id":1,"name":"North Pier","hometown":"Varn","year":1991}
{"id":0,"name":"Quiet Lamps","hometown":"Osk","year":1987}
{"id":3,"name":"Third Rail Choir","hometown":"Mesa Alta","year":2003}
{"id":4,"name":"Paper Ferry","hometown":"Lindholm","year":1979}
"""

PLAYERS = """\
{"id":0,"name":"Ada Rowe","guitars":[0],"band":0}
{"id":1,"name":"Ben Tolo","guitars":[1],"band":1}
{"id":2,"name":"Cleo Marsh","guitars":[1,5],"band":2}
{"id":3,"name":"Dov Perrin","guitars":[3],"band":3}
"""

CARS = """\
{"Name":"corvid 4","Miles_per_Gallon":31,"Cylinders":4,"Displacement":120,"Horsepower":84,"Weight_in_lbs":2400,"Acceleration":15.1,"Year":"1984-01-01","Origin":"USA"}
{"Name":"heron gl","Miles_per_Gallon":24,"Cylinders":6,"Displacement":180,"Horsepower":101,"Weight_in_lbs":3010,"Acceleration":14.2,"Year":"1983-01-01","Origin":"USA"}
{"Name":"wren van","Miles_per_Gallon":44,"Cylinders":4,"Displacement":97,"Horsepower":50,"Weight_in_lbs":2200,"Acceleration":22.5,"Year":"1985-01-01","Origin":"Europe"}
"""

REVISED_CAR = """\
{"Name":"Revised","Miles_per_Gallon":19,"Cylinders":8,"Displacement":300,"Horsepower":131,"Weight_in_lbs":3400,"Acceleration":11.5,"Year":"1971-01-01","Origin":"USA"}
"""

STOCKS = """\
QUUX,Jan 1 2000,12.5
QUUX,Feb 1 2000,13.75
ZORB,Mar 1 2000,40
"""

# Purchases whose window sums are known.
PURCHASES = """\
{"id":"bba25784-487c-408b-9bba-d11ffec32010","time":"2019-02-28T17:02:41.675+02:00","item":"Watch","quantity":1}
{"id":"61d09e51-890e-425a-b7bf-c4bef5e23c2c","time":"2019-02-28T17:03:25.675+02:00","item":"Watch","quantity":9}
{"id":"2954aefd-71c2-47d9-b49a-d421b68b7b76","time":"2019-03-01T00:33:39.675+02:00","item":"iPhone","quantity":4}
{"id":"bf89d72a-e498-41b4-b7cc-f0ec3e0b1829","time":"2019-03-01T07:23:20.675+02:00","item":"iPad","quantity":6}
"""

# Lines sent to the late-data query, grouped by the micro-batch they arrive in.
COLOR_BATCHES = [
    "7000,blue",
    "8000,green",
    "14000,blue",
    "9000,red",
    "15000,red\n8000,blue",
    "13000,green",
    "21000,green",
    "4000,purple",
    "17000,green",
]
