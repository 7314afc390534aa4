"""Small extracts written for the tests, with the defects found in real ones.

Expected values in the tests were worked out by hand from these texts.
"""

SHIPMENTS = """\
Ship ID,Origin City,Dest,Pickup,promised,Delivered Date,CarrierName,Shipment Status,weight,Cost USD,Distance
A-1,Dayton,St. Paul,2025-03-01,2025-03-04,2025-03-04,Red Fox Lines,delivered,1000,1000.00,500
A-2,dayton,Omaha,03/02/2025,03/05/2025,03/07/2025,"Marsh, Hill & Co",delviered,1200,"$1,250.50",250
A-3,TULSA,st. paul,Mar 3 2025,Mar 6 2025,,Red Fox Lines,In-Transit,900,800,400
A-4,Omaha,Winston-salem,4-Mar-2025,7-Mar-2025,6-Mar-2025,"Marsh, Hill & Co",Delivered,1500,"$2,000",1000
A-5,Tulsa,Dayton,2025-03-05,2025-03-20,,Heron Freight,IN TRANSIT,700,650.25,
A-6,Dayton,Omaha,2025-03-06,2025-03-08,,Heron Freight,booked,800,,300
A-7,Omaha,Tulsa,2025-03-07,2025-03-09,,Red Fox Lines,Canceled,600,9999,100
A-8,Tulsa,omaha,2025-03-08,2025-03-10,soon,Heron Freight,DELIVERED,650,300,150
,Tulsa,Omaha,2025-03-08,2025-03-10,,Heron Freight,booked,650,300,150
A-10,Tulsa,Omaha,13/45/2025,2025-03-10,,Heron Freight,booked,650,300,150
A-11,Tulsa,Omaha,2025-03-08,2025-03-10,,Heron Freight,teleporting,650,300,150
A-12,Tulsa,Omaha,2025-02-31,2025-03-10,,Heron Freight,booked,650,300,150
"""

CARRIERS = """\
id,Name,MC Number,Fleet Size,On-Time Pct
C-1,Red Fox Lines,MC-1,"1,200",96.4
C-2,,MC-2,80,91
C-3,Heron Freight,MC-3,n/a,88.5
"""

FACILITIES = """\
code,city,Province,Kind,capacity
DAY-1,DAYTON,oh,cross_dock,12000
STP-1,st. paul,mn,warehouse,
OMA-1,,ne,warehouse,500
"""
