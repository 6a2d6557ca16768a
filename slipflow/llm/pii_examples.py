"""The small labelled table that the conditional random field is trained on.

Invented sentences; personal data stands in [kind text] marks. Numbers that are no personal data
(versions, dates, prices, counts, hashes without a name) are there as counter-examples.
"""

KINDS = ("phone", "card", "id", "iban", "secret")

EXAMPLES = """
call me on [phone (017) 555-7713] after six
the office answers at [phone 555-0143] all day
tel . [phone 030 1234567] , ask for the desk
my number is [phone 415-555-2671] , thanks
please ring [phone (212) 555 0188] or write
Telefon [phone 089 / 4455667] bis zwölf Uhr
fax : [phone 044-555-01-77]
mobile [phone 07700 900123] at weekends
appelez le [phone 01 44 55 66 77] demain
teléfono [phone 91 555 12 34] por favor
phone : [phone 617 555 0199]
reach us under [phone (043) 555-2000] .
her cell is [phone 303-555-0117] .
contact [phone 020 7946 0018] for details
paid with card [card 4111 1111 1111 1111] today
card number [card 5500-0000-0000-0004] was declined
charge [card 3400 000000 00009] please
Karte [card 4000 0000 0000 0002] gültig bis Mai
the card [card 6011-1111-1111-1117] expired
tarjeta [card 4222 2222 2222 2222] caducada
carte [card 4970 1000 0000 0055] refusée
ssn [id 078-05-1120] on file
his social security number is [id 219-09-9999] .
SSN : [id 457-55-5462]
applicant [id 123-45-6789] was accepted
id no . [id 987-65-4320] , born in May
passport [id X1234567] was lost
passport number : [id C01X00T47]
Ausweis [id L01X00T47] verloren
DNI [id 12345678Z] del cliente
transfer to [iban DE89 3704 0044 0532 0130 00] today
IBAN : [iban GB29NWBK60161331926819]
iban [iban FR14 2004 1010 0505 0001 3M02 606] please
pay into [iban ES9121000418450200051332] before noon
token = " [secret cb1a9fee807a05366fcb8b6c95c7c565ede51a72] " in the file
token = " [secret 04dbebab91ab85687d33eeaaf9ac699e1188f962] " and more
password : [secret hunter2xyz99] do not share
api key = [secret sk1f9a8b7c6d5e4f3a2b1c0d] here
secret = " [secret 9f86d081884c7d659a2feaa0c55ad015] " ;
api token : [secret 7d793037a0760186574b0282f2f435e7]
password = [secret Tr0ub4dor3]
TOKEN = " [secret 9233A8ECF7C5B09FE5949719B6B82BC439E9329B] " !!
Licensed under CC BY - NC 4.0 .
This work is licensed under the GNU General Public License , version 3 .
Licensed under the Apache License , Version 2.0 .
the train leaves at 10 : 45 from track 7
it cost 1,250 euros in 2019
chapter 12 , page 348
on 2021-07-01 the rules changed
built in 1998 and sold in 2004
about 300 people and 45 dogs
1 2 3 4 5 6 7 8 9 10
room 101 on floor 3
see table 4 and figure 12.5
order 2669109448945250 has shipped
number 9807915762804490 in the list
the count was 5927243074273351 at noon
between 1914 and 1918
the score was 3 - 2 after 90 minutes
at 12:30 and 18:45 each day
commit 5f367f08b1a8 fixed it
released on 01.02.2003 in Bonn
chapter 3 , section 2 , line 17
the sum of 250 and 750 is 1000
60 seconds in 1 minute
model A4 with 110 kW
"""
